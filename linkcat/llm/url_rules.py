"""URL verdicts: rules by host and path, and a weighted vocabulary counted by Aho-Corasick.

Host and path of a URL are searched at once by one automaton for all terms. A term counts where no ASCII letter or digit
stands next to it. One strict term rejects a URL, and so do ``SOFT`` distinct soft terms; a rule that fits the URL comes
before the vocabulary, and of several the longest.

Rules and terms are arguments (sequences), so their size is the caller's; the URLs are never gathered.

Defined results: a null URL and one without ``://`` have an empty host and path, fit no rule and are allowed; a host is
everything up to the first ``/``, ``?`` or ``#``, user and port included; rows stay as they are, repeated ones included;
rules of equal length that fit the same URL are one rule, the first counts; an empty table gives an empty result; columns
of any name are kept, as results stand beside the row.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from linkcat.llm import text as tx
from linkcat.llm.registry import query, table

SOFT = 2
#: Terms that reject a URL alone, and terms of which several are needed.
STRICT = ("porn", "xxx", "escorts", "hentai", "milf", "camgirls", "malware", "warez", "phishing", "spam", "viagra", "cialis")
SOFT_TERMS = ("adult", "sex", "nude", "erotic", "dating", "casino", "bet", "poker", "jackpot", "pills", "pharmacy", "cheap", "crack", "keygen",
              "torrent", "loan", "replica", "clickbait", "farm", "bonus")
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_PLACE = re.compile(r"://([^/?#]*)([^?#]*)", re.DOTALL)
_WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


class Judge:
    """The automaton and the rules by host."""

    def __init__(self, rules: Sequence[tuple[str, str, str]], strict: Sequence[str], soft: Sequence[str], needed: int):
        self.rules: dict[str, list[tuple[str, str, str]]] = {}
        for host, path, verdict in rules:
            self.rules.setdefault(host, []).append((path, host + path, verdict))
        for fitting in self.rules.values():
            fitting.sort(key=lambda r: -len(r[0]))
        self.needed = needed
        self.terms = ahocorasick.Automaton()
        for weight, words in ((1, soft), (needed, strict)):
            for word in words:
                self.terms.add_word(word.lower(), (word.lower(), weight))
        if len(self.terms):
            self.terms.make_automaton()

    def rule(self, host: str, path: str) -> tuple[str, str] | None:
        """The longest fitting rule and its verdict: the longest host it can have, then the longest path, by total length."""
        best, at = None, 0
        while True:
            for start, name, verdict in self.rules.get(host[at:], ()):
                if path.startswith(start):
                    if best is None or len(name) > len(best[0]):
                        best = (name, verdict)
                    break
            dot = host.find(".", at)
            if dot < 0:
                return best
            at = dot + 1

    def score(self, address: str) -> tuple[int, int]:
        """Weight of the distinct terms found, a strict one weighing as much as is needed; and their number."""
        found = set()
        if len(self.terms):
            for end, (word, weight) in self.terms.iter(address):
                begin = end - len(word) + 1
                if (begin == 0 or address[begin - 1] not in _WORD) and (end + 1 == len(address) or address[end + 1] not in _WORD):
                    found.add((word, weight))
        return sum(w for _, w in found), len(found)


def judge(pages: DataFrame, *, url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES, strict: Sequence[str] = STRICT,
          soft: Sequence[str] = SOFT_TERMS, needed: int = SOFT) -> DataFrame:
    """Each row as the struct ``row`` with ``host``, ``path``, ``rule``, ``weight``, ``n_terms`` and ``verdict``.

    ``rules`` are (host, path, verdict); ``needed`` distinct soft terms reject a URL.
    """
    def start():
        judge = Judge(rules, strict, soft, needed)

        def work(urls: pa.Array) -> dict[str, pa.Array]:
            out: dict[str, list] = {n: [] for n in ("host", "path", "rule", "weight", "n_terms", "verdict")}
            for value in urls.to_pylist():
                parts = _PLACE.search(value or "")
                host, path = (parts[1].translate(_LOWER), parts[2]) if parts else ("", "")
                rule = judge.rule(host, path) if parts else None
                weight, n = judge.score((host + path).translate(_LOWER))
                verdict = rule[1] if rule else "block" if weight >= needed else "allow"
                for name, x in zip(out, (host, path, rule[0] if rule else None, weight, n, verdict), strict=True):
                    out[name].append(x)
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
            return {name: pa.array(x, kind) for (name, x), kind in zip(out.items(), kinds, strict=True)}

        return work

    return tx.add_columns(pages, "host string, path string, rule string, weight long, n_terms long, verdict string", start, url)


def _terms_sql(words: Sequence[str]) -> str:
    return " + ".join(f"CAST(regexp_matches(a, '(^|[^a-z0-9]){w}($|[^a-z0-9])') AS BIGINT)" for w in words)


SQL = rf"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(rh, rp, rv) AS (VALUES {", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in RULES)}),
f AS (SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS rv
  FROM h JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id),
a AS (SELECT page_id, translate(host || path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS a FROM h),
t AS (SELECT page_id, {_terms_sql(STRICT)} AS strict, {_terms_sql(SOFT_TERMS)} AS soft FROM a)
SELECT h.page_id, host, path, rule, coalesce(rv, CASE WHEN strict > 0 OR soft >= {SOFT} THEN 'block' ELSE 'allow' END) AS verdict,
  {SOFT} * strict + soft AS weight
FROM h LEFT JOIN f ON h.page_id = f.page_id JOIN t ON h.page_id = t.page_id
"""


@query("op5_url_vocabulary", SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The URLs of all pages."""
    judged = judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("row.page_id", "host", "path", "rule", "verdict", "weight")
