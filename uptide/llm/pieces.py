"""SentencePiece encoding and decoding as a max-plus scan.

A text is a path through a lattice whose nodes are piece occurrences. For unigram models a path's value is the sum of
its pieces' scores. For BPE models values are 0 or minus infinity: two neighbouring pieces fit if merging their
characters by rank gives just these two pieces, and the encoding is the one path on which all neighbours fit. Either way
the best path is a max-plus product, which is associative.

* Ordinary texts fall into segments at cuts that no piece crosses (before a space, around line ends); each distinct
  segment is solved once per worker and kept in a bounded table.
* Giant texts are split into chunks that are spread over the cluster. Each chunk yields its transfer matrix between the
  nodes at its two boundaries (two vectors where a cut lies inside). A document's matrices are combined into boundary
  vectors and boundary nodes, and every chunk is backtraced on its own between its two nodes.

Models are read on the driver from ``model_file`` (a vocabulary of at most ``MAX_PIECES`` pieces) and sent to the
executors; the library's own encoder is not used. Identity normalisation only: space becomes U+2581, one is put in front.
Scores are float32 values summed as float64, which is exact, so the result does not depend on the chunks.

Edge cases: null and empty texts have no ids and round-trip; characters outside the vocabulary become byte pieces, or
the unknown id without byte fallback (then the round trip is false); repeated rows keep their rows; an empty table gives
an empty result. Of several best unigram paths the one with longer last pieces is taken.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

SPACE = "▁"
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
MAX_PIECES = 1_000_000
GIANT_CHARS = 1 << 15
CHUNK_CHARS = 1 << 13
#: Segments kept per worker, and the longest that is kept.
KEPT_SEGMENTS = 400_000
KEPT_CHARS = 64
MISSING = float("-inf")


@dataclass
class Vocabulary:
    """Pieces with ids and scores; ``bpe`` tells how the best path is defined."""

    ids: dict[str, int]
    scores: dict[str, float]
    bpe: bool
    unknown: int = 0
    byte_ids: list[int] | None = None
    texts: list[bytes] = field(default_factory=list)

    def __post_init__(self):
        self.longest = max(map(len, self.ids), default=1)
        self.inside = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        mixed = any(b[1] == SPACE and b[0] != SPACE for b in self.inside)
        lines = any("\n" in b for b in self.inside)
        self.segment = re.compile(r"(?s:.+)" if mixed else f"{SPACE}*[^{SPACE}]+|{SPACE}+" if lines else f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
        self.unknown_score = min(self.scores.values(), default=0.0) - 10
        self.rank = {p: -s for p, s in self.scores.items() if len(p) > 1}
        self.fits: dict[tuple[str, str], bool] = {}
        #: The same by numbers of pieces: first * ``width`` + second.
        self.fits_by_id: dict[int, bool] = {}
        #: Ids by segment: those met lately, and those met before. Full, the first become the second, so that frequent
        #: segments, which move back when they are met again, are never lost.
        self.solved: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.automaton: ahocorasick.Automaton | None = None
        if self.bpe:
            self.halves = {}
            for p in sorted(self.rank, key=self.rank.get):
                parts = self.merged(p)
                if len(parts) == 1:
                    self.halves[p] = self.last_merge
                else:  # merges never make it
                    del self.rank[p]
            self.ids = {p: i for p, i in self.ids.items() if len(p) == 1 or p in self.rank}
        self.names = {i: p for p, i in self.ids.items()}
        self.width = max(self.names, default=0) + 1

    def matches(self) -> ahocorasick.Automaton:
        """Finds all pieces in a text; built in each worker."""
        if self.automaton is None:
            self.automaton = ahocorasick.Automaton()
            for p in self.ids:
                self.automaton.add_word(p, (len(p), p, self.ids[p]))
            self.automaton.make_automaton()
        return self.automaton

    def __getstate__(self) -> dict:
        return self.__dict__ | {"automaton": None, "fits": {}, "fits_by_id": {}, "solved": {}, "older": {}}

    def merged(self, text: str) -> list[str]:
        """Characters merged by rank, the leftmost of equal ranks first."""
        parts = list(text)
        while len(parts) > 1:
            best, at = min((self.rank.get(parts[i] + parts[i + 1], np.inf), i) for i in range(len(parts) - 1))
            if best == np.inf:
                break
            self.last_merge = (parts[at], parts[at + 1])
            parts[at : at + 2] = ["".join(self.last_merge)]
        return parts

    def fit(self, a: str, b: str) -> bool:
        """Whether b may follow a. The later-made of the two is undone, step by step, down to single characters; if
        some merge across the boundary would have come before the step undone, they do not fit."""
        if not self.bpe:
            return True
        key = (a, b)
        if (known := self.fits.get(key)) is None:
            if len(self.fits) > 2 * KEPT_SEGMENTS:
                self.fits.clear()
            known = self.fits[key] = self._fit(a, b)
        return known

    def _fit(self, a: str, b: str) -> bool:
        limit, left = np.inf, False
        while True:
            across = self.rank.get(a + b)
            if across is not None and (across < limit or across == limit and not left):
                return False
            made_a, made_b = self.rank.get(a, -1), self.rank.get(b, -1)
            if made_a < 0 and made_b < 0:
                return True
            # Of equal ranks the left one is made first; a merge across lies right of a and left of b.
            if left := made_a > made_b:
                limit, a = made_a, self.halves[a][1]
            else:
                limit, b = made_b, self.halves[b][0]

    def weight(self, piece: str) -> float:
        return 0.0 if self.bpe else self.scores.get(piece, self.unknown_score)

    def id_list(self, pieces: list[str]) -> list[int]:
        out = []
        for p in pieces:
            i = self.ids.get(p)
            if i is not None:
                out.append(i)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in p.encode("utf-8", "surrogatepass")]
            else:
                out.append(self.unknown)
        return out


def load(model_file: str = MODEL_FILE) -> Vocabulary:
    """Reads a SentencePiece model file with the public library."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(model_file, "rb") as f:
        proto.ParseFromString(f.read())
    if proto.normalizer_spec.name != "identity" or not proto.normalizer_spec.add_dummy_prefix or proto.normalizer_spec.remove_extra_whitespaces:
        raise ValueError("only identity normalisation with a dummy prefix is supported")
    if len(proto.pieces) > MAX_PIECES or proto.trainer_spec.model_type not in (1, 2):
        raise ValueError("a unigram or BPE model of bounded size is expected")
    model = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    ids, scores, texts, raw = {}, {}, [], [-1] * 256
    for i, p in enumerate(proto.pieces):
        plain = p.type in (1, 4)
        if p.type == 4:
            raise ValueError("user-defined pieces are not supported")
        if plain:
            ids[p.piece], scores[p.piece] = i, p.score
        if model.is_byte(i):
            raw[int(p.piece[3:5], 16)] = i
        # Control pieces decode to nothing.
        texts.append(bytes([int(p.piece[3:5], 16)]) if model.is_byte(i) else p.piece.replace(SPACE, " ").encode() if plain else b"" if model.is_control(i) else "⁇".encode())
    return Vocabulary(ids, scores, proto.trainer_spec.model_type == 2, model.unk_id(), raw if min(raw) >= 0 else None, texts)


def normalised(text: str) -> str:
    return SPACE + text.replace(" ", SPACE) if text else ""


# Lattice -------------------------------------------------------------------------------------------------------------


def ending(v: Vocabulary, s: str, p: int) -> Iterator[str]:
    """Pieces of the lattice that end at position p, the longest first; single characters always exist."""
    for n in range(min(v.longest, p), 1, -1):
        if (t := s[p - n : p]) in v.ids:
            yield t
    if p:
        yield s[p - 1]


def solve(v: Vocabulary, s: str) -> list[str]:
    """Best path of a whole segment, from its start to its end."""
    last: list[str | None] = [None] * (len(s) + 1)  # None: only the single character, which is outside the vocabulary
    if v.bpe:  # just one piece fits at each position
        fits, fitted = v.fits, 0
        for end, (n, t, _) in v.matches().iter(s):
            p = end + 1
            if p == fitted:
                continue
            if p > n:
                before = (last[p - n] or s[p - n - 1], t)
                fit = fits.get(before)
                if not (v.fit(*before) if fit is None else fit):
                    continue
            last[p], fitted = t, p
    else:
        value = [0.0] + [MISSING] * len(s)
        for p in range(1, len(s) + 1):
            for t in ending(v, s, p):
                if (x := value[p - len(t)] + v.weight(t)) > value[p]:
                    value[p], last[p] = x, t
    path, p = [], len(s)
    while p:
        path.append(last[p] or s[p - 1])
        p -= len(path[-1])
    return path[::-1]


def solve_ids(v: Vocabulary, s: str) -> list[int]:
    """Ids of the best path of a whole segment."""
    if not v.bpe:
        return v.id_list(solve(v, s))
    last, size = [-1] * (len(s) + 1), [1] * (len(s) + 1)  # -1: only the single character
    known, width, fitted = v.fits_by_id, v.width, 0
    if len(known) > 2 * KEPT_SEGMENTS:
        known.clear()
    for end, (n, t, i) in v.matches().iter(s):
        p = end + 1
        if p == fitted:  # just one piece fits at each position
            continue
        if p > n:
            before = last[p - n]
            if before < 0:
                fit = v.fit(s[p - n - 1], t)
            elif (fit := known.get(before * width + i)) is None:
                fit = known[before * width + i] = v.fit(v.names[before], t)
            if not fit:
                continue
        last[p], size[p], fitted = i, n, p
    out, p = [], len(s)
    while p:
        if last[p] < 0:
            out += reversed(v.id_list([s[p - 1]]))
        else:
            out.append(last[p])
        p -= size[p]
    out.reverse()
    return out


def _ids_of(v: Vocabulary, s: str) -> bytes:
    """Ids of a segment, from those kept if it was met lately. Marks at its end that no piece joins to what is before are
    looked up apart, so that a word before a full stop is the word."""
    if (part := v.solved.get(s)) is not None:
        return part
    if (part := v.older.get(s)) is None:
        end = len(s) - 1
        while end > 0 and not s[end].isalnum() and s[end - 1 : end + 1] in v.inside:
            end -= 1
        if end > 0 and not s[end].isalnum():
            part = _ids_of(v, s[:end]) + _ids_of(v, s[end:])
        else:
            part = array("i", solve_ids(v, s)).tobytes()
    if len(s) <= KEPT_CHARS:
        if len(v.solved) >= KEPT_SEGMENTS // 2:
            v.older, v.solved = v.solved, {}
        v.solved[s] = part
    return part


def encode_raw(v: Vocabulary, text: str | None) -> bytes:
    """Ids of one text in one piece of work, as 32-bit numbers."""
    segments = v.segment.findall(normalised(text or ""))
    parts = list(map(v.solved.get, segments))
    at = -1
    for _ in range(parts.count(None)):
        at = parts.index(None, at + 1)
        parts[at] = _ids_of(v, segments[at])
    return b"".join(parts)


def encode(v: Vocabulary, text: str | None) -> list[int]:
    return np.frombuffer(encode_raw(v, text), np.int32).tolist()


def decode(v: Vocabulary, ids) -> str:
    data = b"".join([v.texts[i] for i in ids])
    return data.decode("utf-8", "replace").removeprefix(" ")


def boundary(v: Vocabulary, s: str, at: int) -> list[tuple[int, int]]:
    """Nodes (end, length) around a boundary: all that the first piece beyond it may follow, in a fixed order."""
    return [(p, len(t)) for p in range(max(0, at - v.longest) + 1, at + 1) for t in ending(v, s, p)] or [(0, 0)]


def _step(v: Vocabulary, s: str, p: int, value: dict[int, dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """Values of the nodes that end at p, from those at earlier positions."""
    found = {}
    for t in ending(v, s, p):
        best = None
        for u, x in value.get(p - len(t), {}).items():
            if not u or v.fit(u, t):
                best = x + v.weight(t) if best is None else np.maximum(best, x + v.weight(t))
        if best is not None:
            found[t] = best
    return found


def _cut(v: Vocabulary, s: str, positions: range) -> int | None:
    """The first of the positions that no piece crosses: nothing beyond it depends on what is before."""
    return next((p for p in positions if s[p - 1 : p + 1] not in v.inside), None)


def _node_values(v: Vocabulary, s: str, value: dict[int, dict[str, np.ndarray]], a: int, b: int) -> None:
    """Extends the values of the nodes that end up to a by those that end up to b."""
    for p in range(a + 1, b + 1):
        value[p] = _step(v, s, p, value)
        if p - 2 * v.longest > a:  # out of reach
            value.pop(p - 2 * v.longest, None)


def transfer(v: Vocabulary, s: str, a: int, b: int) -> tuple[np.ndarray | None, np.ndarray | None, np.ndarray | None]:
    """Max-plus matrix from the nodes at a to those at b (positions in s): dense, or two vectors whose outer sum it is,
    up to a constant, if a cut lies between. Then only the stretches before the first and after the last cut are read."""
    entries, exits = boundary(v, s, a), boundary(v, s, b)
    unit = np.full((len(entries), len(entries)), MISSING)
    np.fill_diagonal(unit, 0.0)
    value: dict[int, dict[str, np.ndarray]] = {}
    for row, (p, n) in zip(unit, entries, strict=True):
        value.setdefault(p, {})[s[p - n : p]] = row
    first = _cut(v, s, range(a + 1, b - v.longest + 1))
    left, width = None, len(entries)
    if first is None:
        _node_values(v, s, value, a, b)
    else:
        _node_values(v, s, value, a, first)
        left = np.max(list(value[first].values()), axis=0)
        last = _cut(v, s, range(b - v.longest, first - 1, -1))
        value, width = {last: {"": np.zeros(1)}}, 1
        _node_values(v, s, value, last, b)
    columns = np.array([value.get(p, {}).get(s[p - n : p], np.full(width, MISSING)) for p, n in exits]).T
    return (columns, None, None) if left is None else (None, left, columns[0])


def _between(v: Vocabulary, s: str, start: int, before: str, end: int, piece: str | None) -> list[str]:
    """Best pieces from a node (an end and its piece; empty: a cut) to another (None: any that ends there)."""
    value: dict[int, dict[str, tuple[float, str]]] = {start: {before: (0.0, "")}}
    for p in range(start + 1, end + 1):
        found = {}
        for t in ending(v, s, p):
            for u, (x, _) in value.get(p - len(t), {}).items():
                if (not u or v.fit(u, t)) and (t not in found or x + v.weight(t) > found[t][0]):
                    found[t] = (x + v.weight(t), u)
        value[p] = found
    path, p = [], end
    t = max(value[end], key=lambda t: (value[end][t][0], len(t))) if piece is None and end > start else piece
    while p > start:
        path.append(t)
        p, t = p - len(t), value[p][t][1]
    return path[::-1]


def backtrace(v: Vocabulary, s: str, entry: tuple[int, int], exit_: tuple[int, int]) -> list[str]:
    """Best pieces after the entry node up to the exit node; what lies between cuts is solved by segments."""
    (start, n), (end, m) = entry, exit_
    before, piece = s[start - n : start], s[end - m : end]
    first = _cut(v, s, range(start + 1, end - m + 1))
    if first is None:
        return _between(v, s, start, before, end, piece)
    last = _cut(v, s, range(end - m, first - 1, -1))
    inner = [t for x in v.segment.findall(s[first:last]) for t in solve(v, x)]
    return _between(v, s, start, before, first, None) + inner + _between(v, s, last, "", end, piece)


def combine(matrices: list[tuple], nodes: list[list[tuple[int, int]]]) -> list[tuple[int, int]]:
    """The best path's node at each boundary. nodes[i] stand before matrix i; the last list is that at the text's end."""
    vectors = [np.zeros(1)]
    for dense, left, right in matrices:
        x = vectors[-1]
        vectors.append(np.max(x[:, None] + dense, axis=0) if dense is not None else right + np.max(x + left))
    end = max(p for p, _ in nodes[-1])
    at = max((i for i, (p, _) in enumerate(nodes[-1]) if p == end), key=lambda i: (vectors[-1][i], nodes[-1][i][1]))
    chosen = [at]
    for i in range(len(matrices) - 1, -1, -1):
        dense, left, _ = matrices[i]
        total = vectors[i] + (dense[:, chosen[-1]] if dense is not None else left)
        best = np.max(total)
        chosen.append(max((j for j in range(len(total)) if total[j] == best), key=lambda j: nodes[i][j]))
    return [nodes[i][j] for i, j in enumerate(reversed(chosen))]


# Spark ---------------------------------------------------------------------------------------------------------------


def _ids_array(lists: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(lists) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in lists], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(lists), np.int32)))


def _chunks(size: int, chunk: int) -> list[tuple[int, int]]:
    return [(a, min(size, a + chunk)) for a in range(0, size, chunk)]


def encode_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    model_file: str = MODEL_FILE,
    giant_chars: int = GIANT_CHARS,
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """``doc_id, n_tokens, ids, round_trip`` per document; ``round_trip`` tells whether decoding gives the text back."""
    shared = docs.sparkSession.sparkContext.broadcast(load(model_file))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    given = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    out = T.StructType(
        [given.schema["doc_id"], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())]
    )

    def row_batch(ids_column: pa.Array, lists: list[bytes], texts: list[str]) -> pa.RecordBatch:
        same = [decode(shared.value, np.frombuffer(x, np.int32).tolist()) == t for x, t in zip(lists, texts, strict=True)]
        return pa.RecordBatch.from_arrays([ids_column, pa.array([len(x) // 4 for x in lists], pa.int64()), _ids_array(lists), pa.array(same, pa.bool_())], names=out.names)

    def whole(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = part.column("text").to_pylist()
                yield row_batch(part.column("doc_id"), [encode_raw(shared.value, t) for t in texts], texts)

    length = F.length("text")
    ordinary = given.where(length < giant_chars).mapInArrow(whole, out)
    giants = given.where(length >= giant_chars).withColumn("key", F.xxhash64("doc_id", "text"))
    return ordinary.unionByName(_encode_giants(giants, shared, out, row_batch, max(chunk_chars, 4 * shared.value.longest)))


def _encode_giants(giants: DataFrame, shared, out: T.StructType, row_batch, chunk_chars: int) -> DataFrame:
    piece = T.StructType([T.StructField(n, t()) for n, t in (("key", T.LongType), ("chunk", T.IntegerType), ("a", T.IntegerType), ("b", T.IntegerType), ("s", T.StringType))])

    def split(batches):
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                s, back = normalised(text), 2 * shared.value.longest
                for c, (a, b) in enumerate(_chunks(len(s), chunk_chars)):
                    lo = max(0, a - back)
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((key, pa.int64()), (c, pa.int32()), (a - lo, pa.int32()), (b - lo, pa.int32()), (s[lo:b], pa.string()))], names=piece.names)

    # Copies of a giant text under one id are encoded once.
    chunks = giants.select("key", "text").dropDuplicates(["key"]).mapInArrow(split, piece).repartition("key", "chunk")
    found = T.StructType(
        [T.StructField("key", T.LongType()), T.StructField("chunk", T.IntegerType()), *(T.StructField(n, T.BinaryType()) for n in ("dense", "left", "right", "entries", "exits")), T.StructField("width", T.IntegerType()), T.StructField("at", T.IntegerType())]
    )

    def matrices(batches):
        for batch in batches:
            for key, c, a, b, s in zip(*(batch.column(n).to_pylist() for n in piece.names), strict=True):
                result = transfer(shared.value, s, a, b)
                raw = [None if m is None else np.ascontiguousarray(m).tobytes() for m in result]
                sides = [np.array(boundary(shared.value, s, x), np.int32) - np.array([x, 0], np.int32) for x in (a, b)]
                columns = [*raw, *(x.tobytes() for x in sides)]
                arrays = [pa.array([key], pa.int64()), pa.array([c], pa.int32()), *(pa.array([x], pa.binary()) for x in columns), pa.array([len(sides[1])], pa.int32()), pa.array([b - a], pa.int32())]
                yield pa.RecordBatch.from_arrays(arrays, names=found.names)

    def scanned(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        vector = lambda x: None if x is None else np.frombuffer(x)
        steps = [(None if d is None else vector(d).reshape(-1, w), vector(x), vector(y)) for d, x, y, w in zip(rows.dense, rows.left, rows.right, rows.width, strict=True)]
        sides = [np.frombuffer(x, np.int32).reshape(-1, 2) for x in [rows.entries.iloc[0], *rows.exits]]
        # Node ends are kept relative to their boundary; a common order is all that combine needs.
        chosen = combine(steps, [[tuple(map(int, n)) for n in side] for side in sides])
        return pd.DataFrame({"key": rows.key.to_numpy(), "chunk": rows.chunk.to_numpy(), "p": [n[0] for n in chosen[:-1]], "n": [n[1] for n in chosen[:-1]], "q": [n[0] for n in chosen[1:]], "m": [n[1] for n in chosen[1:]]})

    nodes = chunks.mapInArrow(matrices, found).groupBy("key").applyInPandas(scanned, "key long, chunk int, p int, n int, q int, m int")
    traced = T.StructType([T.StructField("key", T.LongType()), T.StructField("chunk", T.IntegerType()), T.StructField("part", T.ArrayType(T.IntegerType()))])

    def trace(batches):
        for batch in batches:
            rows = zip(*(batch.column(x).to_pylist() for x in ("a", "b", "s", "p", "n", "q", "m")), strict=True)
            lists = [np.array(shared.value.id_list(backtrace(shared.value, s, (a + p, n), (b + q, m))), np.int32).tobytes() for a, b, s, p, n, q, m in rows]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("chunk"), _ids_array(lists)], names=traced.names)

    parts = chunks.join(nodes, ["key", "chunk"]).mapInArrow(trace, traced)
    ids = parts.groupBy("key").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "part"))), lambda x: x["part"])).alias("ids"))

    def finish(batches):
        for batch in batches:
            ids = [np.asarray(x, np.int32).tobytes() for x in batch.column("ids").to_pylist()]
            yield row_batch(batch.column("doc_id"), ids, batch.column("text").to_pylist())

    return giants.join(ids, "key").select("doc_id", "text", "ids").mapInArrow(finish, out)


def decode_documents(encoded: DataFrame, *, ids_col: str = "ids", model_file: str = MODEL_FILE) -> DataFrame:
    """The frame with a column ``decoded``: the text of the ids (null for null)."""
    shared = encoded.sparkSession.sparkContext.broadcast(load(model_file))
    back = F.pandas_udf(lambda ids: ids.map(lambda x: None if x is None else decode(shared.value, x)), "string")
    return encoded.withColumn("decoded", back(F.col(ids_col)))
