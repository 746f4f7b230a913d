"""Documents read one at a time in Python: their values, statements and compacted text.

What ``nodes.walk_values`` and the expressions on its rows say about a value is said here about a variant's bytes, many times
faster: a row for each value costs more than the value. Functions that take Arrow batches give back a few hundred documents'
rows at a time, so a worker's memory depends on the size of a document only.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import sys
from collections.abc import Callable, Iterator, Sequence
from decimal import Decimal
from typing import NamedTuple

import pyarrow as pa

from linkcat.config import RDF_TYPE, XSD, Catalog
from linkcat.functions.digest import LANES, LANE_WIDTH
from linkcat.functions.urls import IS_URL

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
NIL = RDF + "nil"
MEDIA_KEYS = ("filePath", "contentUrl", "downloadUrl")
#: Documents of which the rows are given back together.
SLICE = 256
OBJECT, LIST, REVERSE, ARRAY, STOPPED, SCALAR = "object", "list", "reverse", "array", "stopped", "scalar"

# In Java an end of input also lies before a last line break.
_END = "(?=(?:\r\n|[\n\r\u0085  ])?\\Z)"
_ABSOLUTE = re.compile(IS_URL.removesuffix("$") + _END + r"|^(?:_|mailto|urn|tag|doi|tel|data):", re.ASCII)
_SLASHES = re.compile("^/|/" + _END)
_ESCAPED = re.compile(r'["\\\x00-\x1f]')
_SHORT = {'"': '\\"', "\\": "\\\\", "\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r"}


class Number(NamedTuple):
    """A number that is no integer of 64 bits: DOUBLE, FLOAT or DECIMAL, and how many numbers stand before it in the document."""

    kind: str
    value: object
    rank: int


class Other(NamedTuple):
    """A value of a kind that JSON lacks, as text and as JSON."""

    kind: str
    text: str
    json: str


class Entries(dict):
    """An object's entries, with where it begins and ends in the bytes of its document."""

    __slots__ = ("start", "end")


class Reader:
    """Decodes variants; metadata that documents share are read once."""

    def __init__(self, zone: str = "UTC"):
        self.zone, self.known = zone, {}

    def read(self, value: bytes, metadata: bytes):
        keys = self.known.get(metadata)
        if keys is None:
            if len(self.known) > 4096:
                self.known.clear()
            keys = self.known[metadata] = _keys(metadata)
        self.value, self.keys, self.numbers = value, keys, 0
        return self._at(0)

    def _at(self, pos: int):
        v = self.value
        head = v[pos]
        basic, info = head & 3, head >> 2
        if basic == 1:
            return v[pos + 1 : pos + 1 + info].decode()
        if basic == 2:
            width, id_width, wide = (info & 3) + 1, ((info >> 2) & 3) + 1, 4 if info >> 4 & 1 else 1
            n = int.from_bytes(v[pos + 1 : pos + 1 + wide], "little")
            ids = pos + 1 + wide
            offsets = ids + n * id_width
            data = offsets + (n + 1) * width
            out, keys, at = Entries(), self.keys, self._at
            starts = _numbers(v, offsets, n + 1, width)
            for key, start in zip(_numbers(v, ids, n, id_width), starts):
                start += data
                head = v[start]
                if head & 3 == 1:  # most values are short strings
                    out[keys[key]] = v[start + 1 : start + 1 + (head >> 2)].decode()
                else:
                    out[keys[key]] = at(start)
            out.start, out.end = pos, data + starts[n]
            return out
        if basic == 3:
            width, wide = (info & 3) + 1, 4 if info >> 2 & 1 else 1
            n = int.from_bytes(v[pos + 1 : pos + 1 + wide], "little")
            offsets = pos + 1 + wide
            data = offsets + (n + 1) * width
            return [self._at(data + start) for start in _numbers(v, offsets, n, width)]
        return self._primitive(info, pos + 1)

    def _primitive(self, info: int, pos: int):
        v = self.value
        whole = lambda size, at=pos: int.from_bytes(v[at : at + size], "little", signed=True)
        if info == 0:
            return None
        if info <= 2:
            return info == 1
        if info == 16:
            size = whole(4)
            return v[pos + 4 : pos + 4 + size].decode()
        if info <= 10 or info == 14:
            rank, self.numbers = self.numbers, self.numbers + 1
            if info <= 6:
                return whole(1 << info - 3)
            if info == 7:
                return Number("DOUBLE", struct.unpack_from("<d", v, pos)[0], rank)
            if info == 14:
                return Number("FLOAT", struct.unpack_from("<f", v, pos)[0], rank)
            number = Decimal(whole(4 << info - 8, pos + 1)).scaleb(-v[pos])
            return Number("DECIMAL", _plain(number), rank)
        return _other(info, v, pos, whole, self.zone)


def _numbers(v: bytes, at: int, n: int, width: int) -> Sequence[int]:
    """Unsigned numbers that lie side by side."""
    if width == 1:
        return v[at : at + n]
    if width == 2:
        return struct.unpack_from(f"<{n}H", v, at)
    return [int.from_bytes(v[i : i + width], "little") for i in range(at, at + n * width, width)]


def _keys(metadata: bytes) -> list[str]:
    width = (metadata[0] >> 6) + 1
    num = lambda i: int.from_bytes(metadata[1 + i * width : 1 + (i + 1) * width], "little")
    n = num(0)
    data = 1 + (n + 2) * width
    ends = [num(1 + i) for i in range(n + 1)]
    return [metadata[data + a : data + b].decode() for a, b in zip(ends, ends[1:])]


def _plain(number: Decimal) -> Decimal:
    """Without zeros at the end of the fraction."""
    sign, digits, exponent = number.as_tuple()
    while exponent < 0 and len(digits) > 1 and digits[-1] == 0:
        digits, exponent = digits[:-1], exponent + 1
    if digits == (0,):
        sign, exponent = 0, 0
    return Decimal((sign, digits, exponent))


def _other(info: int, v: bytes, pos: int, whole, zone: str) -> Other:
    from base64 import b64encode
    from datetime import UTC, date, datetime, timedelta
    from uuid import UUID
    from zoneinfo import ZoneInfo

    if info == 11:
        text = (date(1970, 1, 1) + timedelta(days=whole(4))).isoformat()
        return Other("DATE", text, json_string(text))
    if info in (12, 13):
        moment = datetime(1970, 1, 1, tzinfo=UTC) + timedelta(microseconds=whole(8))
        if info == 12:
            moment = moment.astimezone(ZoneInfo(zone))
        text = moment.strftime("%Y-%m-%d %H:%M:%S")
        text = (text + f".{moment.microsecond:06d}".rstrip("0")).rstrip(".") if moment.microsecond else text
        offset = moment.strftime("%z")
        return Other("TIMESTAMP" if info == 12 else "TIMESTAMP_NTZ", text, json_string(text + (f"{offset[:3]}:{offset[3:]}" if info == 12 else "")))
    if info == 15:
        raw = v[pos + 4 : pos + 4 + whole(4)]
        return Other("BINARY", raw.decode(errors="replace"), json_string(b64encode(raw).decode()))
    if info == 20:
        text = str(UUID(bytes=v[pos : pos + 16]))
        return Other("UUID", text, json_string(text))
    raise ValueError(f"a variant's primitive type {info} is not known")


def java_double(x: float) -> str:
    """A double as Java writes it, with the fewest digits that name it."""
    if x != x or x in (float("inf"), float("-inf")):
        return "NaN" if x != x else "Infinity" if x > 0 else "-Infinity"
    sign, digits, exponent = Decimal(repr(x)).as_tuple()
    text = "".join(map(str, digits)).rstrip("0") or "0"
    point = len(digits) + exponent  # places before the point
    minus = "-" if sign else ""
    if x == 0:
        return minus + "0.0"
    if -3 < point <= 7:
        if point <= 0:
            return f"{minus}0.{'0' * -point}{text}"
        return f"{minus}{text[:point].ljust(point, '0')}.{text[point:] or '0'}"
    return f"{minus}{text[0]}.{text[1:] or '0'}E{point - 1}"


def json_string(text: str) -> str:
    """A string as JSON."""
    if _ESCAPED.search(text) is None:
        return f'"{text}"'
    return '"' + _ESCAPED.sub(lambda m: _SHORT.get(m[0]) or f"\\u{ord(m[0]):04X}", text) + '"'


def to_json(value, numbers: Callable[[Number], str] | None = None) -> str:
    """JSON of a value; ``numbers`` may know how a number was written."""
    if isinstance(value, str):
        return json_string(value)
    if isinstance(value, Entries):
        return "{" + ",".join(f"{json_string(k)}:{to_json(x, numbers)}" for k, x in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ",".join(to_json(x, numbers) for x in value) + "]"
    if isinstance(value, Other):
        return value.json
    if isinstance(value, Number) and numbers is not None:
        return numbers(value)
    return "null" if value is None else _scalar_text(value, plain=True)


def _scalar_text(value, plain: bool = False) -> str:
    if value is True or value is False:
        return "true" if value else "false"
    if isinstance(value, Number):
        if value.kind == "DECIMAL":
            return f"{value.value:f}" if plain else str(value.value)
        if value.kind == "FLOAT":
            import numpy as np

            return java_double(float(str(np.float32(value.value))))
        return java_double(value.value)
    return str(value)


def text_of(value) -> str | None:
    """A value as a string, objects and arrays as JSON; NULL of null."""
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, (Entries, list)):
        return to_json(value)
    return value.text if isinstance(value, Other) else _scalar_text(value)


def text_at(value, key: str) -> str | None:
    """The string under a key of an object."""
    return text_of(value.get(key)) if isinstance(value, Entries) else None


def from_json(value):
    """Python's reading of JSON as values of a document."""
    if isinstance(value, dict):
        out = Entries((k, from_json(x)) for k, x in value.items())
        out.start = out.end = 0
        return out
    if isinstance(value, list):
        return [from_json(x) for x in value]
    return Number("DOUBLE", value, 0) if isinstance(value, float) else value


class Term(NamedTuple):
    """What a context says about a term."""

    iri: str | None = None
    kind: str | None = None
    container: str | None = None
    back: bool = False
    lang: str | None = None


NO_TERM = Term()
Terms = dict[str, Term]
NO_TERMS: Terms = {}


class Names:
    """How names and ids read under contexts."""

    def __init__(self, catalog: Catalog, named: dict[str, dict] | None = None):
        self.catalog, self.prefixes = catalog, catalog.context_prefixes
        self.named = {name: from_json(context.get("@context", context)) for name, context in (named or {}).items()}
        origins = {origin: prefix + ":" for prefix, origin in self.prefixes.items()}
        self._curies = origins, _longest(origins)
        terms = {**origins, catalog.vocab: ""}
        self._terms = terms, _longest(terms)
        self._expanded: dict[str, str] = {}
        self._short: dict[str, str] = {}

    def enter(self, terms: Terms, context) -> Terms:
        """The terms after a context: see ``graph.enter_context``."""
        for one in context if isinstance(context, list) else [context]:
            found = one if isinstance(one, Entries) else self.named.get(text_of(one)) if one is not None else None
            if one is None:
                terms = {}
            elif isinstance(found, Entries):
                terms = {**terms, **{k: _definition(k, v) for k, v in found.items()}}
        return terms

    def expand(self, terms: Terms, name: str | None) -> str | None:
        """IRI of a term or CURIE."""
        if name is None:
            return None
        if terms:
            return self._expand(terms, name)
        got = self._expanded.get(name)
        if got is None:
            got = self._expand(terms, name)
            if len(self._expanded) < 65_536:
                self._expanded[name] = got
        return got

    def _expand(self, terms: Terms, name: str) -> str:
        own = terms.get(name, NO_TERM).iri
        name = name if own is None else own
        prefix, colon, local = name.partition(":")
        if not colon:
            vocab = terms.get("@vocab", NO_TERM).iri
            return (self.catalog.vocab if vocab is None else vocab) + name
        origin = terms.get(prefix, NO_TERM).iri
        origin = self.prefixes.get(prefix) if origin is None else origin
        return name if local.startswith("//") or origin is None or prefix == "_" else origin + local

    def resolve(self, terms: Terms, ref: str) -> str:
        """Absolute form of an id."""
        prefix, colon, local = ref.partition(":")
        if terms:
            own = terms.get(prefix, NO_TERM).iri if not ref.startswith("_:") else None
            if own is not None and colon and not local.startswith("//"):
                return own + local
            base = terms.get("@base", NO_TERM).iri
            if base is not None and not colon:
                return base + ref
        if _ABSOLUTE.search(ref):
            return ref
        if colon:
            origin = self.prefixes.get(prefix)
            return ref if origin is None else origin + local
        return self.catalog.base + _SLASHES.sub("", ref)

    def short(self, iri: str, vocab: bool = True) -> str:
        """Shortest name of an IRI: see ``graph.compact_iri``."""
        if vocab and iri == RDF_TYPE:
            return "@type"
        names, pattern = self._terms if vocab else self._curies
        found = pattern.match(iri)
        return names[found[0]] + iri[found.end() :] if found else iri

    def short_term(self, terms: Terms, name: str) -> str:
        """Shortest name of a term or CURIE."""
        if terms:
            return self.short(self.expand(terms, name))
        got = self._short.get(name)
        if got is None:
            got = self.short(self.expand(terms, name))
            if len(self._short) < 65_536:
                self._short[name] = got
        return got


def _longest(names: dict[str, str]) -> re.Pattern:
    return re.compile("|".join(re.escape(o) for o in sorted(names, key=len, reverse=True)))


def _definition(key: str, v) -> Term:
    back, own = text_at(v, "@reverse"), text_at(v, "@id")
    iri = back if back is not None else own if own is not None else text_of(v)
    return Term(iri, text_at(v, "@type"), text_at(v, "@container"), back is not None, text_at(v, "@language"))


def below(label: str, step: str) -> str:
    """Label of a place from that of the container."""
    if "%" in step or "." in step:
        step = step.replace("%", "%25").replace(".", "%2E")
    return f"{label}.{step}" if label else step


def own_label(ref: str | None) -> str | None:
    """An id as it is, but a document's own blank labels kept apart from those made here."""
    return "_:u" + ref[2:] if ref is not None and ref[:3] in ("_:b", "_:c", "_:u") else ref


def cell_label(label: str, position: int) -> str:
    """Label of a list's cell."""
    return f"_:c{below(label, '@list')}.{position}"


def items_of(entries) -> list:
    """Items of a list object."""
    items = entries["@list"]
    return items if isinstance(items, list) else [items]


class Found(NamedTuple):
    """A value that a walk has found; ``kind`` is that of ``nodes.walk_values``, before it is opened."""

    path: tuple[str, ...]
    label: str
    owner: str | None
    prop: str | None
    value: object
    kind: str
    id: str | None
    back: bool
    terms: Terms
    place: tuple[str, ...]


def walk(body, stop: Callable[[Entries, str | None], bool] | None, names: Names | None = None, name: Callable[[Terms, str], str] | None = None) -> Iterator[Found]:
    """Every object, list, stopped object and scalar of a document, as ``nodes.walk_values`` has them.

    Scalars have the last step of their path only, and a label where they stand in a list.
    """
    kind = OBJECT if isinstance(body, Entries) else ARRAY if isinstance(body, list) else SCALAR
    todo = [Found((), "", None, None, body, kind, _id(kind, body, "", _own(body, {}, names)), False, {}, ())]
    while todo:
        x = todo.pop()
        kind, value = x.kind, x.value
        if kind is SCALAR or kind is STOPPED:
            yield x
            continue
        if kind is ARRAY:
            nested = x.prop == "@list"
            for i, v in enumerate(value):
                step = str(i)
                todo.append(_found(x, step, f"\u0001{i:010d}" if name else None, x.owner, x.prop, v, nested, x.back, x.terms, stop, names))
            continue
        terms = x.terms
        if kind is REVERSE:
            owner, back = x.owner, True
        else:
            yield x
            owner, back = x.id, False
            if names is not None and "@context" in value:
                terms = names.enter(terms, value["@context"])
        place = x.place
        for key, v in value.items():
            if key == "@context":
                continue
            if not isinstance(v, (Entries, list)) and (not terms or terms.get(key, NO_TERM).container != "@list"):
                label = below(x.label, key) if key == "@list" else ""
                yield Found((key,), label, owner, key, v, SCALAR, None, back, terms, (*place, name(terms, key)) if name else place)
            else:
                todo.append(_found(x, key, name(terms, key) if name else None, owner, key, v, False, back, terms, stop, names))


def objects(body, media: bool) -> Iterator[tuple[tuple[str, ...], str | None, str | None, Entries, str]]:
    """Path, owner, property, value and id of every object of a document, or of those that stand for media, without contexts.

    What ``walk`` gives there, but scalars are passed over: outside of contexts none becomes an object.
    """
    todo = [((), "", None, None, body, False)]
    while todo:
        path, label, owner, prop, value, nested = todo.pop()
        if isinstance(value, Entries) and "@set" in value:
            bare = value["@set"]
            if not path:
                bare = value
        else:
            bare = value
        if nested and isinstance(value, list):
            bare = from_list(bare)
        if isinstance(bare, list):
            inner, whose = prop == "@list", owner
            for i, v in enumerate(bare):
                if isinstance(v, (Entries, list)):
                    step = str(i)
                    todo.append(((*path, step), f"{label}.{step}" if label else step, whose, prop, v, inner))
            continue
        if not isinstance(bare, Entries):
            continue
        if media and path and is_media(bare, prop):
            yield path, owner, prop, bare, _id(STOPPED, bare, label, _own(bare, NO_TERMS, None))
            continue
        if path and prop == "@reverse":
            whose = owner
        elif path and "@list" in bare:
            whose = _id(LIST, bare, label, None)
        else:
            whose = _id(OBJECT, bare, label, _own(bare, NO_TERMS, None))
            if not media or (not path and any(k in bare for k in MEDIA_KEYS)):
                yield path, owner, prop, bare, whose
        for key, v in bare.items():
            if isinstance(v, (Entries, list)) and key != "@context":
                todo.append(((*path, key), below(label, key), whose, key, v, False))


def _own(value, terms: Terms, names: Names | None) -> str | None:
    """The ``@id`` of an object, absolute where contexts count."""
    if not isinstance(value, Entries) or "@id" not in value:
        return None
    own = own_label(text_of(value["@id"]))
    if names is None or own is None:
        return own
    return names.resolve(names.enter(terms, value["@context"]) if "@context" in value else terms, own)


def _id(kind: str, value, label: str, own: str | None) -> str | None:
    if kind is OBJECT or kind is STOPPED:
        return "_:b" + label if own is None else own
    if kind is LIST:
        return cell_label(label, 0) if items_of(value) else NIL
    return None


def _found(x: Found, step: str, named: str | None, owner, prop, value, nested: bool, back: bool, terms: Terms, stop, names: Names | None) -> Found:
    bare = value
    if isinstance(value, Entries) and "@set" in value:
        bare = value["@set"]
    if nested or (terms and terms.get(prop, NO_TERM).container == "@list"):
        kept = (isinstance(value, Entries) and "@list" in value) or value is None or (nested and not isinstance(value, list))
        if not kept:
            bare = from_list(bare if isinstance(bare, list) else [bare])
    label = below(x.label, step)
    kind, id = SCALAR, None
    if isinstance(bare, Entries):
        if stop is not None and stop(bare, prop):
            kind = STOPPED
        elif prop == "@reverse":
            kind = REVERSE
        else:
            kind = LIST if "@list" in bare else OBJECT
        if kind is not REVERSE:
            id = _id(kind, bare, label, _own(bare, terms, names))
    elif isinstance(bare, list):
        kind = ARRAY
    return Found((*x.path, step), label, owner, prop, bare, kind, id, back, terms, (*x.place, named) if named is not None else x.place)


def from_list(items: list) -> Entries:
    """A list object of the items."""
    out = Entries({"@list": items})
    out.start = out.end = 0
    return out


def is_value_object(entries: Entries, _: str | None) -> bool:
    """Whether an object stands for a literal."""
    return "@value" in entries


def is_media(entries: Entries, prop: str | None) -> bool:
    """Whether an object stands for media: by its keys, or an encoding made of file parts."""
    if any(k in entries for k in MEDIA_KEYS):
        return True
    if prop != "encoding":
        return False
    one = entries.get("hasPart")
    parts = one if isinstance(one, list) else [one]
    return any(text_at(p, "filePath") is not None for p in parts)


def _kind(value) -> str:
    if value is None:
        return "VOID"
    if isinstance(value, str):
        return "STRING"
    if value is True or value is False:
        return "BOOLEAN"
    if isinstance(value, int):
        return "BIGINT"
    return value.kind if isinstance(value, (Number, Other)) else "COMPOUND"


def statements(body, names: Names) -> Iterator[tuple]:
    """Statements of a document with the number that an object is yet to be written from, if it is one: see ``graph.expand``."""
    iri_properties = names.catalog.iri_properties
    expand, resolve = names.expand, names.resolve
    for x in walk(body, is_value_object, names):
        owner, prop, terms = x.owner, x.prop, x.terms
        if owner is None or (prop[:1] == "@" and prop != "@type" and prop != "@list"):
            continue
        term = terms.get(prop, NO_TERM) if terms else NO_TERM
        is_value, is_node = x.kind is STOPPED, x.kind is OBJECT or x.kind is LIST
        scalar = x.value["@value"] if is_value else x.value
        kind = "OBJECT" if is_node else _kind(scalar)
        if kind == "VOID":
            continue
        iri = datatype = language = object = number = None
        object_kind = "literal"
        if is_node:
            iri = x.id
        else:
            string = text_of(scalar) if kind != "DOUBLE" else None
            named = kind == "STRING" and not is_value
            if prop == "@type" or (named and term.kind == "@vocab"):
                iri = expand(terms, text_of(scalar))
            elif named and (term.kind == "@id" or prop in iri_properties):
                iri = resolve(terms, own_label(string))
        if iri is not None:
            object, object_kind = iri, "blank" if iri[:2] == "_:" else "iri"
        else:
            coerced = expand(terms, term.kind) if term.kind is not None and term.kind[:1] != "@" else None
            declared = expand(terms, text_at(x.value, "@type")) if is_value else coerced
            if is_value:
                language = text_at(x.value, "@language")
            elif kind == "STRING" and coerced is None:
                language = term.lang if term.lang is not None else terms["@language"].iri if "@language" in terms else None
            object, datatype = string, declared
            if kind == "BIGINT":
                datatype = XSD + "integer" if declared is None else declared
            elif kind == "BOOLEAN":
                datatype = XSD + "boolean" if declared is None else declared
            elif kind in ("DOUBLE", "DECIMAL", "FLOAT"):
                size = float(scalar.value)
                if abs(size) < 1e18 and size == int(size):
                    object, datatype = str(int(size)), XSD + "integer" if declared is None else declared
                elif declared is None:
                    object, number, datatype, object_kind = None, scalar, XSD + "double", "number"
                elif kind == "DOUBLE":
                    number = scalar
        subject = owner
        if prop == "@list":
            predicate = RDF + "first"
            subject = f"_:c{x.label}.0" if x.path[-1] == "@list" else f"_:c{x.label}"
        else:
            predicate = RDF_TYPE if prop == "@type" else expand(terms, prop)
        if x.back == term.back:
            yield subject, predicate, object, object_kind, datatype, language, number
        elif iri is not None:
            yield iri, predicate, subject, "blank" if subject[:2] == "_:" else "iri", None, None, None
        if x.kind is LIST:
            n = len(items_of(x.value))
            for i in range(n):
                after = cell_label(x.label, i + 1) if i + 1 < n else NIL
                yield cell_label(x.label, i), RDF + "rest", after, "blank" if i + 1 < n else "iri", None, None, None


def labelled(body, names: Names, numbers: Callable[[Number], str]) -> list[tuple]:
    """Statements of a document as a set, blank nodes under canonical labels: see ``graph.label_blank_nodes``."""
    rows = list({(s, p, o, k, d, la, n and float(n.value)): (s, p, o, k, d, la, n) for s, p, o, k, d, la, n in statements(body, names)}.values())
    written = lambda n: numbers(n) if n.kind == "DOUBLE" else java_double(float(n.value))
    about: dict[str, list[tuple]] = {}
    for row in rows:
        if row[0][:2] == "_:":
            about.setdefault(row[0], []).append(row)
        if row[3] == "blank" and row[2] != row[0]:
            about.setdefault(row[2], []).append(row)
    if not about:
        return rows
    hashed = []
    for me, said in about.items():
        mask = lambda c: "_:a" if c == me else "_:z" if c[:2] == "_:" else c  # noqa: B023
        lanes = [0] * LANES
        for s, p, o, k, d, la, n in said:
            o = o if n is None else written(n)
            text = mask(o) if k == "blank" else "^".join(t for t in (k, o, d or "", la or "") if t is not None)
            one = hashlib.sha256(f"{mask(s)} {p} {text}".encode()).hexdigest()
            for i in range(LANES):
                lanes[i] += int(one[LANE_WIDTH * i : LANE_WIDTH * (i + 1)], 16)
        hashed.append((hashlib.sha1(":".join(map(str, (len(said), *lanes))).encode()).hexdigest(), me))
    labels = {me: f"_:c14n{i}" for i, (_, me) in enumerate(sorted(hashed))}
    return [(labels.get(s, s), p, labels.get(o, o) if k == "blank" else o, k, d, la, n) for s, p, o, k, d, la, n in rows]


#: Between the compacted and the written form of a key in a step of a place; before a key that reads backwards; and before a position.
WRITTEN, BACKWARDS, AT = "\u0002", "\u0003", "\u0001"


class Slot(NamedTuple):
    """A value of a document as JSON, with where it stands: what it is in, and under what name."""

    place: tuple[str, ...]
    above: tuple[str, ...] | None
    name: str | None
    text: str | None


def _where(place: tuple[str, ...]) -> tuple[tuple[str, ...] | None, str | None]:
    """What a place is in, and its name there; a root has neither, nor has what stands in arrays only."""
    for at in range(len(place) - 1, -1, -1):
        if place[at][0] != AT:
            return place[:at], place[at].partition(WRITTEN)[0]
    return None, None


def _object_text(*entries: tuple[str, str | None]) -> str:
    """JSON object of the entries that are not NULL."""
    return "{" + ",".join(f'"{k}":{v}' for k, v in entries if v is not None) + "}"


def slots(body, names: Names, numbers: Callable[[Number], str]) -> Iterator[Slot]:
    """Values of a document under the catalog's own context, objects and lists still empty."""
    refs = names.catalog.iri_properties
    short = lambda iri, vocab=True: json_string(names.short(iri, vocab))
    typed = lambda terms, t: json_string(names.short_term(terms, t))

    backwards = []

    def named(terms: Terms, key: str) -> str:
        name = key if key[:1] == "@" else names.short_term(terms, key)
        if terms and terms.get(key, NO_TERM).back:
            backwards.append(key)
            return BACKWARDS + name + WRITTEN + key
        return name + WRITTEN + key

    def text_of_row(x: Found, name: str | None) -> str:
        prop, value, terms = x.prop or "", x.value, x.terms
        if x.kind is STOPPED:
            datatype, tag, bare = text_at(value, "@type"), text_at(value, "@language"), to_json(value["@value"], numbers)
            if datatype is None and tag is None:
                return bare
            return _object_text(("@language", None if tag is None else json_string(tag)), ("@type", None if datatype is None else typed(terms, datatype)), ("@value", bare))
        if x.kind is not SCALAR:
            return '{"@list":[]}' if x.kind is LIST else "{}"
        term = terms.get(prop, NO_TERM) if terms else NO_TERM
        as_node = lambda iri: iri if name in refs else _object_text(("@id", iri))
        if isinstance(value, str):
            if prop == "@id":
                return short(names.resolve(terms, value), False)
            if prop == "@type":
                return typed(terms, value)
            if prop[:1] != "@" or prop == "@list":
                if term.kind == "@id" or prop in refs:
                    return as_node(short(names.resolve(terms, value), False))
                if term.kind == "@vocab":
                    return as_node(typed(terms, value))
        plain = to_json(value, numbers)
        if prop[:1] == "@" and prop != "@list":
            return plain
        if term.kind is not None and term.kind[:1] != "@":
            return _object_text(("@type", typed(terms, term.kind)), ("@value", plain))
        language = term.lang if term.lang is not None else terms["@language"].iri if "@language" in terms else None
        if isinstance(value, str) and language is not None:
            return _object_text(("@language", json_string(language)), ("@value", plain))
        return plain

    for x in walk(body, is_value_object, names, named):
        if x.value is None:
            continue
        place = x.place
        if backwards and any(s[0] == BACKWARDS for s in place):
            place = tuple(t for s in place for t in ((f"@reverse{WRITTEN}@reverse", s[1:]) if s[0] == BACKWARDS else (s,)))
        above, name = _where(place)
        yield Slot(place, above, name, text_of_row(x, name))


def _node_text(kids: list[tuple[str, tuple[str, ...], str]], name: str | None, names: Names) -> str:
    """JSON object of entries (name, place, text); one that is nothing but an id is the id where a property asks for one."""
    kids.sort()
    if len(kids) == 1 and kids[0][0] == "@id" and name in names.catalog.iri_properties:
        return kids[0][2]
    by_name: dict[str, list[str]] = {}
    for key, _, text in kids:
        by_name.setdefault(key, []).append(text)
    return "{" + ",".join(json_string(key) + ":" + (
        texts[0] if len(texts) == 1 and key not in ("@list", "@graph") else f"[{','.join(texts)}]") for key, texts in by_name.items()) + "}"


def put_together(rows: list[Slot], names: Names) -> list[str | None]:
    """The JSON text from the values of the documents of one key, bottom-up, one pass a level; nothing if none has a root."""
    own = {r.place: r for r in rows}
    if len(own) == len(rows):
        return _headed([_of_one(own, names)] if () in own else [], names)
    for level in range(max((len(r.above) for r in rows if r.above is not None), default=-1), -1, -1):
        own = {}
        kids: dict[tuple, list] = {}
        for r in rows:
            if r.above is not None and len(r.above) == level:
                kids.setdefault(r.above, []).append((r.name, r.place, r.text))
            elif r.place not in own or (own[r.place].text or "") < (r.text or ""):
                own[r.place] = r
        # What stands below @reverse has no row of its own above it.
        for place in kids.keys() - own.keys():
            own[place] = Slot(place, *_where(place), None)
        rows = [r._replace(text=_node_text(kids[r.place], r.name, names)) if r.place in kids else r for r in own.values()]
    return _headed([r.text for r in rows if not r.place], names)


def _of_one(own: dict[tuple[str, ...], Slot], names: Names) -> str | None:
    """The text of the root where no two values have one place."""
    levels: dict[int, list[Slot]] = {}
    for r in own.values():
        if r.above is not None:
            levels.setdefault(len(r.above), []).append(r)
    for level in range(max(levels, default=-1), -1, -1):
        kids: dict[tuple, list] = {}
        for r in levels.get(level, ()):
            kids.setdefault(r.above, []).append((r.name, r.place, own[r.place].text))
        for place, inner in kids.items():
            r = own.get(place)
            if r is None:  # what stands below @reverse has no row of its own above it
                r = Slot(place, *_where(place), None)
                if r.above is not None:
                    levels.setdefault(len(r.above), []).append(r)
            own[place] = r._replace(text=_node_text(inner, r.name, names))
    return own[()].text


def _headed(texts: list[str | None], names: Names) -> list[str | None]:
    """The text of a root with the catalog's context."""
    if not any(texts):
        return texts[:1]
    head = '{"@context":' + json_string(names.catalog.context)
    text = max(t for t in texts if t is not None)
    return [head + ("}" if text == "{}" else "," + text[1:])]


def _number_texts(text: str) -> Callable[[Number], str]:
    """How numbers were written in the JSON text of a document."""
    found: list[str] = []

    def known(number: Number) -> str:
        if not found:
            json.loads(text, parse_float=found.append, parse_int=found.append, parse_constant=found.append)
        return found[number.rank]

    return known


Edit = tuple[list[str], list[tuple[str, str | None]]]


class Piece(NamedTuple):
    """A part of a body under change: where it stands, whether it is a new entry (rank 1), its text or the kind of container it is."""

    place: tuple[str, ...]
    rank: int
    kind: str
    text: str | None


def pieces(value, edits: list[Edit], numbers: Callable[[Number], str], missing: bool) -> Iterator[Piece]:
    """A body's parts: containers on the way to an edit opened, all else as it is written, and a part for each new entry."""
    todo = [((), value, edits)]
    while todo:
        place, value, edits = todo.pop()
        level = len(place)
        here = [e for e in edits if len(e[0]) == level]
        if missing or not edits or not (isinstance(value, Entries) or (isinstance(value, list) and len(edits) > len(here))):
            yield Piece(place, 0, "", None if missing else to_json(value, numbers))
            continue
        below_ = lambda step: [e for e in edits if len(e[0]) > level and e[0][level] == step]  # noqa: B023
        if isinstance(value, list):
            yield Piece(place, 0, "array", None)
            todo.extend(((*place, f"{AT}{i:010d}"), v, below_(str(i))) for i, v in enumerate(value))
            continue
        yield Piece(place, 0, "object", None)
        todo.extend(((*place, k), v, below_(k)) for k, v in value.items())
        for _, entries in here:
            yield from (Piece((*place, k), 1, "", text) for k, text in entries)


def joined_text(rows: list[Piece], depth: int) -> str | None:
    """The JSON text of the parts of the bodies of one key, put together from the given depth upwards."""
    for level in range(depth, -1, -1):
        own: dict[tuple, tuple[str, str | None]] = {}
        kids: dict[tuple, list] = {}
        for r in rows:
            if len(r.place) == level + 1:
                kids.setdefault(r.place[:level], []).append((r.place[-1], r.rank, r.text is not None, r.text or ""))
                own.setdefault((r.place[:level], 0), ("", None))
            else:
                kind, text = own.get((r.place, r.rank), ("", None))
                own[r.place, r.rank] = max(kind, r.kind), r.text if text is None or (r.text is not None and text < r.text) else text
        rows = []
        for (place, rank), (kind, text) in own.items():
            if len(place) == level and text is None and kind:
                inner = sorted(kids.get(place, ())) if rank == 0 else []
                if kind == "array":
                    text = "[" + ",".join(t for _, _, some, t in inner if some) + "]"
                else:  # the last of a key is the new entry, if there is one
                    last = {step: (some, t) for step, _, some, t in inner}
                    text = "{" + ",".join(f"{json_string(step)}:{t}" for step, (some, t) in last.items() if some) + "}"
            rows.append(Piece(place, rank, kind, text))
    return rows[0].text


def changed_rows(keys: list[str], depth: int, zone: str):
    """A function of Arrow batches, sorted by ``keys``, that gives each key once with the text of its body after ``_edits``."""
    inner = ("body", "_text", "_edits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(zone)
        rows: list[Piece] = []
        held = Held("_body")
        for batch, low, high in _slices(batches):
            column = lambda n: batch.column(batch.schema.get_field_index(n))  # noqa: B023
            keep = batch.select([n for n in batch.schema.names if n not in inner])
            whose = list(zip(*(column(k).slice(low, high - low).to_pylist() for k in keys)))
            texts, edits = (column(n).slice(low, high - low).to_pylist() for n in ("_text", "_edits"))
            raw = _raw(batch, low, high)
            for i in range(low, high):
                if held.begins(whose[i - low]):
                    held.close([joined_text(rows, depth)] if rows else [])
                    rows.clear()
                    held.begin(whose[i - low], keep, i)
                asked = [(e["path"], e["entries"]) for e in edits[i - low] or ()]
                text = texts[i - low]
                if text is None:
                    rows.extend(pieces(None, asked, to_json, True))
                if raw[i - low] is not None:
                    rows.extend(pieces(reader.read(*raw[i - low]), asked, _number_texts(text), False))
            if held.full():
                yield held.flush()
        held.close([joined_text(rows, depth)] if rows else [])
        if held.texts:
            yield held.flush()

    return run


class Held:
    """Rows that are done, the columns of their key's first document with a text, and the key at hand."""

    def __init__(self, name: str):
        self.name, self.key, self.last, self.rows, self.texts = name, None, None, [], []

    def begins(self, key: tuple) -> bool:
        return self.last is None or key != self.key

    def begin(self, key: tuple, keep: pa.RecordBatch, i: int) -> None:
        self.key, self.last = key, keep.slice(i, 1)

    def close(self, texts: list[str | None]) -> None:
        for text in texts:
            self.rows.append(self.last)
            self.texts.append(text)

    def full(self) -> bool:
        return len(self.texts) >= SLICE

    def flush(self) -> pa.RecordBatch:
        kept = pa.Table.from_batches(self.rows).combine_chunks().to_batches()[0]
        out = pa.RecordBatch.from_arrays([*kept.columns, pa.array(self.texts, pa.string())], schema=kept.schema.append(pa.field(self.name, pa.string())))
        self.rows, self.texts = [], []
        return out


def compacted_rows(catalog: Catalog, named: dict[str, dict] | None, zone: str):
    """A function of Arrow batches, sorted by all columns but ``body`` and ``_text``, that gives one compacted JSON text for each key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, reader = Names(catalog, named), Reader(zone)
        rows: list[Slot] = []
        held = Held("document")
        for batch, low, high in _slices(batches):
            keep = batch.select([n for n in batch.schema.names if n not in ("body", "_text")])
            keys = list(zip(*(c.slice(low, high - low).to_pylist() for c in keep.columns)))
            texts, raw = batch.column(batch.schema.get_field_index("_text")).slice(low, high - low).to_pylist(), _raw(batch, low, high)
            for i in range(low, high):
                if held.begins(keys[i - low]):
                    held.close(put_together(rows, names))
                    rows.clear()
                    held.begin(keys[i - low], keep, i)
                text = texts[i - low]
                if text is None:  # a body that is left out: a root without a text
                    rows.append(Slot((), None, None, None))
                if raw[i - low] is not None:
                    rows.extend(slots(reader.read(*raw[i - low]), names, _number_texts(text)))
            if held.full():
                yield held.flush()
        held.close(put_together(rows, names))
        if held.texts:
            yield held.flush()

    return run


def _raw(batch: pa.RecordBatch, low: int, high: int) -> list[tuple[bytes, bytes] | None]:
    """Bytes and metadata of the bodies of some rows of a batch, NULL of those that are NULL."""
    body = batch.column(batch.schema.get_field_index("body")).slice(low, high - low)
    pairs = list(zip(body.field("value").to_pylist(), body.field("metadata").to_pylist()))
    return [p if there else None for p, there in zip(pairs, body.is_valid().to_pylist())] if body.null_count else pairs


def _bodies(batch: pa.RecordBatch, reader: Reader, low: int, high: int) -> Iterator[tuple[int, object]]:
    """Position and value of the bodies of some rows of a batch, those that are NULL left out."""
    for i, raw in enumerate(_raw(batch, low, high), low):
        if raw is not None:
            yield i, reader.read(*raw)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, int]]:
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 20_000))  # a body may be nested 1,000 deep
    for batch in batches:
        for low in range(0, batch.num_rows, SLICE):
            yield batch, low, min(low + SLICE, batch.num_rows)


def _kept(batch: pa.RecordBatch, at: list[int], left_out: tuple[str, ...]) -> tuple[list[pa.Array], list[pa.Field]]:
    """The columns of the rows' documents."""
    fields = [f for f in batch.schema if f.name not in left_out]
    rows = pa.array(at, pa.int32())
    return [batch.column(batch.schema.get_field_index(f.name)).take(rows) for f in fields], fields


def _said(row: tuple) -> tuple:
    """What makes statements the same: a number by its text."""
    number = row[6]
    return row[:6] if number is None else (*row[:2], java_double(float(number.value)), *row[3:6])


class Once:
    """Statements that the documents of one key have not made before; those of a key that several have are known by 128 bits."""

    def __init__(self):
        self.key, self.seen = None, set()

    def of(self, rows: Iterator[tuple], key: tuple, documents: int) -> list[tuple]:
        fresh = {_said(row): row for row in rows}
        if documents == 1:
            return list(fresh.values())
        if key != self.key:
            self.key, self.seen = key, set()
        out = []
        for said, row in fresh.items():
            code = hashlib.blake2b(repr(said).encode(errors="surrogatepass"), digest_size=16).digest()
            if code not in self.seen:
                self.seen.add(code)
                out.append(row)
        return out


def statement_rows(catalog: Catalog, named: dict[str, dict] | None, zone: str, labels: bool, once: bool = False):
    """A function of Arrow batches that gives the statements of documents, with canonical labels if asked.

    Or each ``once`` for a key, where batches are sorted by all columns but ``body`` and ``_n``, the number of documents of a key.
    """
    fields = [pa.field(n, pa.string()) for n in ("subject", "predicate", "object", "object_kind", "datatype", "lang")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, reader, new = Names(catalog, named), Reader(zone), Once()
        for batch, low, high in _slices(batches):
            at, rows = [], []
            if once:
                keep = batch.select([n for n in batch.schema.names if n not in ("body", "_n")])
                keys = list(zip(*(c.slice(low, high - low).to_pylist() for c in keep.columns)))
                counts = batch.column(batch.schema.get_field_index("_n")).slice(low, high - low).to_pylist()
            for i, body in _bodies(batch, reader, low, high):
                before = len(rows)
                if once:
                    rows.extend(new.of(statements(body, names), keys[i - low], counts[i - low]))
                    at.extend([i] * (len(rows) - before))
                    continue
                rows.extend(labelled(body, names, _number_texts(batch.column(batch.schema.get_field_index("_text"))[i].as_py())) if labels else statements(body, names))
                at.extend([i] * (len(rows) - before))
            if rows:
                kept, of = _kept(batch, at, ("body", "_text"))
                columns = list(zip(*rows))
                arrays = [pa.array(c, pa.string()) for c in columns[:6]]
                number = pa.array([None if n is None else float(n.value) for n in columns[6]], pa.float64())
                yield pa.RecordBatch.from_arrays([*kept, *arrays, number], schema=pa.schema([*of, *fields, pa.field("_number", pa.float64())]))

    return run


def object_rows(zone: str, media: bool, values: bool):
    """A function of Arrow batches that gives the objects of documents, or those that stand for media, with their ``value`` if asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(zone)
        for batch, low, high in _slices(batches):
            at, found, raw = [], [], []
            for i, body in _bodies(batch, reader, low, high):
                value = reader.value
                for x in objects(body, media):
                    at.append(i)
                    found.append(x)
                    if values:
                        raw.append(value[x[3].start : x[3].end])
            if not at:
                continue
            kept, of = _kept(batch, at, ("body",))
            paths, owners, props, _, ids = zip(*found)
            columns = {"path": pa.array(paths, pa.list_(pa.string())), "owner": pa.array(owners, pa.string()), "prop": pa.array(props, pa.string())}
            fields = [*of, *(pa.field(n, c.type) for n, c in columns.items())]
            if values:
                body = batch.schema.field("body")
                whose = batch.column(batch.schema.get_field_index("body")).field("metadata").take(pa.array(at, pa.int32()))
                columns["value"] = pa.StructArray.from_arrays([pa.array(raw, pa.binary()), whose], fields=list(body.type))
                fields.append(pa.field("value", body.type))
            columns["id"] = pa.array(ids, pa.string())
            yield pa.RecordBatch.from_arrays([*kept, *columns.values()], schema=pa.schema([*fields, pa.field("id", pa.string())]))

    return run
