"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

The public model is of the BPE kind. Its segmentation of a word is the only one in which every pair of neighbouring
pieces is *stable*: merging the two pieces' characters by rank gives these two pieces again. So the search needs no
simulation of merges: a state is the last piece of a prefix, its predecessor is the state where the piece begins, and a
transition scores 0 if the pair is stable and minus infinity otherwise. Exactly one candidate survives at every
position, and the vectorised maximum over the candidate lengths stores it as backpointer.

* Words are runs of spaces with the characters after them, cut again wherever no piece holds two neighbouring
  characters; no piece crosses such a cut. Distinct words of a slice are searched once.
* Words of equal length advance together. Substrings are looked up by their hash in sorted piece keys and confirmed
  by a second hash.
* Whether a pair is stable is worked out for arrays of pairs at once, by undoing the latest merge of either side as long as
  the merge across the border would come later.
* Characters without a piece become byte pieces.

Only the pieces, scores and kinds are read from the file. It must have no normalisation beyond the leading space and
spaces written as U+2581, and byte pieces for unknown characters, else ``Pieces`` refuses it.

Defined results: null and empty texts have no ids and decode to an empty text; a text comes back as it was, except that
U+2581 inside a text reads as a space; rows stay as they are, repeated ones included; an empty table gives an empty
result; columns of any name are kept, as results stand beside the row.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkcat.llm import text as tx
from linkcat.llm.registry import query, table

SPACE = 0x2581
_NEVER = np.int64(1 << 40)
#: A worker remembers the ids of about so many distinct words.
WORDS = 250_000
#: A worker remembers the stability of pairs of pieces in a table of so many bits.
PAIR_BITS = 20
SLICE_BYTES = 2 << 20


class Pieces:
    """The tables of a model file."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.normalize("ﬁ Ａ  a ") != "▁ﬁ▁Ａ▁▁a▁":
            raise ValueError("the model normalises texts; only models that don't are read")
        n = model.vocab_size()
        self.unknown = model.unk_id()
        self.bytes = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        if (self.bytes == self.unknown).any():
            raise ValueError("the model has no byte pieces")
        special = [i for i in range(n) if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)]
        ordinary = sorted(set(range(n)) - set(special))
        text = [model.id_to_piece(i) for i in range(n)]
        for i in special:
            text[i] = ""
        if any(chr(SPACE) in t.lstrip(chr(SPACE)) for t in text):
            raise ValueError("a piece has a space after a character")
        self.text = text
        #: Rank of the merge that makes a piece: the better its score, the earlier; single characters need none.
        order = sorted((i for i in ordinary if len(text[i]) > 1), key=lambda i: (-model.get_score(i), i))
        self.rank = np.full(n, -1, np.int64)
        self.rank[order] = np.arange(len(order))
        self.longest = max(len(text[i]) for i in ordinary)
        ids = {text[i]: i for i in ordinary}
        self.left, self.right = (np.full(n, -1, np.int32) for _ in range(2))
        reachable = set(i for i in ordinary if len(text[i]) == 1)
        for i in order:
            halves = self._last_merge(text[i], ids)
            if halves:
                self.left[i], self.right[i] = halves
                reachable.add(i)
        keys = np.array(sorted(reachable), np.int32)
        points = [np.array([ord(c) for c in text[i]], np.uint64) for i in keys]
        flat, size = np.concatenate(points), np.array([len(p) for p in points])
        end = np.cumsum(size)
        one, two = (tx.run_hashes(flat, end - size, end, p) for p in (tx._WORDS, tx._SECOND))
        by = np.argsort(one)
        self.key, self.check, self.id = one[by], two[by], keys[by]
        pairs = np.concatenate([(p[:-1] << np.uint64(21)) | p[1:] for p in points])
        self.pairs = np.unique(pairs)
        #: Every way to cut a piece into two pieces, as sorted pairs, with the rank of the whole.
        cut = sorted((ids[text[i][:k]] * n + ids[text[i][k:]], int(self.rank[i])) for i in order for k in range(1, len(text[i]))
                     if text[i][:k] in ids and text[i][k:] in ids)
        self.joint, self.joint_rank = np.array([c for c, _ in cut], np.int64), np.array([r for _, r in cut], np.int64)
        self.n = n
        later = np.maximum(self.rank[np.maximum(self.left, 0)], self.rank[np.maximum(self.right, 0)])
        if (later[self.left >= 0] > self.rank[self.left >= 0]).any():
            raise ValueError("a piece is merged before its parts")
        self.words: dict[int, bytes] = {}
        self.pair_key, self.pair_stable = np.full(1 << PAIR_BITS, -1), np.zeros(1 << PAIR_BITS, bool)

    def _last_merge(self, text: str, ids: dict[str, int]) -> tuple[int, int] | None:
        """The two pieces whose merge makes ``text``, if merging by rank makes it at all."""
        parts = list(text)
        while len(parts) > 2:
            best = min(((self.rank[i], k) for k in range(len(parts) - 1) if (i := ids.get(parts[k] + parts[k + 1])) is not None), default=None)
            if best is None:
                return None
            k = best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        found = tuple(ids.get(p) for p in parts)
        return found if None not in found else None

    def _merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the piece that the two make together, or never."""
        pair = a.astype(np.int64) * self.n + b
        at = np.minimum(np.searchsorted(self.joint, pair), len(self.joint) - 1)
        return np.where(self.joint[at] == pair, self.joint_rank[at], _NEVER)

    def stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the characters of both pieces by rank leaves the border between them."""
        pair = a.astype(np.int64) * self.n + b
        slot = (tx.mix(pair.view(np.uint64)) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        out, new = self.pair_stable[slot], self.pair_key[slot] != pair
        if new.any():
            once, back = np.unique(pair[new], return_inverse=True)
            out[new] = self._undo(once // self.n, once % self.n)[back]
            self.pair_key[slot[new]], self.pair_stable[slot[new]] = pair[new], out[new]
        return out

    def _undo(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Go back in time on both sides of the border; a merge across it that would have come first breaks the pair.

        Between the creation of the border's two current pieces and the merge that ends the first of them, a merge across
        the border has its chance. At equal ranks the leftmost merge comes first, so the left piece's own merge precedes
        the border's, and the border's precedes the right piece's.
        """
        ok = np.ones(len(a), bool)
        end = np.full(len(a), _NEVER * 4)  # the time at which the current pair ends: 4 * rank + place
        on = np.arange(len(a))
        while len(on):
            x, y = a[on], b[on]
            cross = self._merge_rank(x, y)
            broken = (cross < _NEVER) & (4 * cross + 1 < end[on])
            ok[on[broken]] = False
            made_x = np.where(self.rank[x] >= 0, 4 * self.rank[x], -1)
            made_y = np.where(self.rank[y] >= 0, 4 * self.rank[y] + 2, -1)
            go = ~broken & ((made_x >= 0) | (made_y >= 0))
            on, x, y, made_x, made_y = on[go], x[go], y[go], made_x[go], made_y[go]
            undo_x = made_x > made_y
            end[on] = np.maximum(made_x, made_y)
            a[on] = np.where(undo_x, self.right[x], x)
            b[on] = np.where(undo_x, y, self.left[y])
        return ok

    def lookup(self, points: tx.PrefixSums, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the substrings are pieces, and these pieces."""
        one = tx.run_hashes_at(points, low, high, 0)
        at = np.minimum(np.searchsorted(self.key, one), len(self.key) - 1)
        row = np.flatnonzero(self.key[at] == one)
        at = at[row]
        same = self.check[at] == tx.run_hashes_at(points, low[row], high[row], 1)
        return row[same], self.id[at[same]]

    def segment(self, points: tx.PrefixSums, begin: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Last piece (-1 for an unknown character) and its length for every prefix of the words of ``size`` characters that begin at ``begin``."""
        best = np.full((len(begin), size + 1), -1, np.int32)
        length = np.zeros((len(begin), size + 1), np.int16)
        for end in range(1, size + 1):
            spans = min(end, self.longest)
            score = np.full((spans, len(begin)), -np.inf, np.float32)
            piece = np.full((spans, len(begin)), -1, np.int32)
            for k in range(1, spans + 1):
                low = begin + end - k
                row, found = self.lookup(points, low, low + k)
                if not len(row):
                    continue
                piece[k - 1, row] = found
                if end == k:
                    good = np.ones(len(row), bool)
                else:
                    before = best[row, end - k]
                    good = before < 0  # nothing merges with an unknown character
                    some = np.flatnonzero(~good)
                    good[some] = self.stable(before[some], found[some])
                score[k - 1, row[good]] = 0
            top = np.argmax(score, 0)
            lone = score[top, np.arange(len(begin))] == -np.inf
            best[:, end] = np.where(lone, -1, piece[top, np.arange(len(begin))])
            length[:, end] = np.where(lone, 1, top + 1)
        return best, length

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        points = [np.frombuffer((" " + t).encode("utf-32-le"), np.uint32) if t else np.zeros(0, np.uint32) for t in texts]
        size = np.array([len(p) for p in points])
        first = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        flat = np.concatenate(points).astype(np.uint64) if len(points) else np.zeros(0, np.uint64)
        if not len(flat):
            return [np.zeros(0, np.int32) for _ in texts]
        flat[flat == 0x20] = SPACE
        cut = np.ones(len(flat), bool)
        pair = (flat[:-1] << np.uint64(21)) | flat[1:]
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        cut[1:] = self.pairs[at] != pair
        cut[first[:-1][size > 0]] = True
        begin = np.flatnonzero(cut)
        end = np.append(begin[1:], len(flat))
        one, two = (tx.run_hashes(flat, begin, end, p) for p in (tx._WORDS, tx._SECOND))
        _, chosen, of = np.unique(tx.mix(one) ^ two, return_index=True, return_inverse=True)
        if (one != one[chosen[of]]).any() or (two != two[chosen[of]]).any():
            _, chosen, of = np.unique(np.stack([one, two], 1), axis=0, return_index=True, return_inverse=True)
        names = [a << 64 | b for a, b in zip(one[chosen].tolist(), two[chosen].tolist(), strict=True)]
        ids = [self.words.get(name) for name in names]
        new = np.array([i for i, x in enumerate(ids) if x is None], np.int64)
        if len(new):
            if len(self.words) > WORDS:
                self.words.clear()
            size = (end - begin)[chosen[new]]
            at = np.concatenate([[0], np.cumsum(size)])
            small = flat[np.repeat(begin[chosen[new]] - at[:-1], size) + np.arange(at[-1])]
            for i, found in zip(new.tolist(), self._search(small, at), strict=True):
                ids[i] = self.words[names[i]] = found.tobytes()
        count = np.array([len(x) // 4 for x in ids])
        every = np.frombuffer(b"".join(ids), np.int32)
        start = np.cumsum(count) - count
        n = count[of]
        total = np.concatenate([[0], np.cumsum(n)])
        spread = every[np.repeat(start[of] - total[:-1], n) + np.arange(total[-1])]
        edge = total[np.searchsorted(begin, first)]
        return [spread[edge[i] : edge[i + 1]] for i in range(len(texts))]

    def _search(self, points: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """The ids of the words that ``at`` cuts from ``points``; words of one length go together."""
        sums, size = tx.PrefixSums(points), np.diff(at)
        out: list[np.ndarray] = [None] * len(size)
        order = np.argsort(size, kind="stable")
        groups = np.flatnonzero(np.diff(size[order], prepend=-1))
        for low, high in zip(groups.tolist(), np.append(groups[1:], len(order)).tolist(), strict=True):
            n = int(size[order[low]])
            step = max(1, 400_000 // n)
            for a in range(low, high, step):
                part = order[a : min(a + step, high)]
                best, length = self.segment(sums, at[part], n)
                for w, found in zip(part.tolist(), self._trace(best, length, points, at[part], n), strict=True):
                    out[w] = found
        return out

    def _trace(self, best: np.ndarray, length: np.ndarray, flat: np.ndarray, begin: np.ndarray, size: int) -> list[np.ndarray]:
        """Follow the backpointers of all words together; unknown characters become bytes."""
        n = len(begin)
        at, on = np.full(n, size), np.arange(n)
        steps = []
        while len(on):
            steps.append((on, best[on, at[on]], at[on]))
            at[on] = at[on] - length[on, at[on]]
            on = on[at[on] > 0]
        word, piece, end = (np.concatenate(x) for x in zip(*steps, strict=True))
        order = np.lexsort((end, word))
        word, piece, end = word[order], piece[order], end[order]
        odd = np.flatnonzero(piece < 0)
        if len(odd):
            raw = [self.bytes[list(chr(int(flat[begin[word[i]] + end[i] - 1])).encode("utf-8", "surrogatepass"))] for i in odd]
            many = np.ones(len(piece), np.int64)
            many[odd] = [len(r) for r in raw]
            place = np.cumsum(many) - many
            out = np.repeat(piece, many)
            for i, r in zip(odd, raw, strict=True):
                out[place[i] : place[i] + len(r)] = r
            word, piece = np.repeat(word, many), out
        return np.split(piece, np.searchsorted(word, np.arange(1, n)))

    @property
    def surface(self) -> list[bytes]:
        """The bytes that each id stands for."""
        if not hasattr(self, "_surface"):
            self._surface = [t.replace(chr(SPACE), " ").encode() for t in self.text]
            for b, i in enumerate(self.bytes):
                self._surface[i] = bytes([b])
        return self._surface

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; the space that encoding put first is taken off."""
        surface = self.surface
        return b"".join([surface[i] for i in ids.tolist()]).decode("utf-8", "replace").removeprefix(" ")


@lru_cache(4)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _encoder(path: str, back: bool):
    def start():
        model = pieces(path)

        def work(texts: pa.Array) -> dict[str, pa.Array]:
            found = model.encode_all([t or "" for t in texts.to_pylist()])
            at = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            out = {"ids": pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(found) if found else [], pa.int32()))}
            return out | {"decoded": pa.array([model.decode(x) for x in found], pa.string())} if back else out

        return work

    return start


def encode(docs: DataFrame, path: str, *, text: str = "text") -> DataFrame:
    """Each row as the struct ``row`` with ``ids``; ``path`` is the model file, the same on all machines."""
    return tx.add_columns(docs, "ids array<int>", _encoder(path, back=False), text, SLICE_BYTES)


def encode_and_decode(docs: DataFrame, path: str, *, text: str = "text") -> DataFrame:
    """Each row as the struct ``row`` with ``ids`` and the text they decode to, ``decoded``, in one pass."""
    return tx.add_columns(docs, "ids array<int>, decoded string", _encoder(path, back=True), text, SLICE_BYTES)


def decode(encoded: DataFrame, path: str, *, ids: str = "ids") -> DataFrame:
    """``encoded`` with the text of ``ids`` in ``decoded``; null ids decode to an empty text."""
    def run(batches):
        model = pieces(path)
        for batch in batches:
            lists = batch.column(ids)
            flat, at = np.asarray(lists.flatten().fill_null(0)), np.concatenate([[0], np.cumsum(np.asarray(pa.compute.list_value_length(lists).fill_null(0)))])
            out = [model.decode(flat[at[i] : at[i + 1]]) for i in range(len(lists))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, encoded.withColumn("decoded", F.lit("")).schema)


@query("op3_sentencepiece")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents to ids and back: the number of ids, their digest, the digest of the decoded text and whether it is the text."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    both = encode_and_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    whole = F.coalesce("row.text", F.lit(""))
    return both.select("row.doc_id", F.size("ids").cast("long").alias("n_ids"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"), (F.translate(whole, "▁", " ") == F.col("decoded")).alias("round_trip"))
