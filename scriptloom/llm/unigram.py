"""SentencePiece encoding and decoding over the pieces and scores of a model file, by max-plus products.

The ids of a text are the pieces of the segmentation with the largest sum of scores (ties: at every place the
longest last piece), over the text as the file's normaliser leaves it: a leading space is added and spaces are
written as U+2581. Characters without a piece cost ten less than the least score and come out as their bytes. The
file at hand was trained by merges; here its pieces and scores are read as a unigram model, since merges are not a
sum that chunks could share, so the ids are not those of the library's merges.

Segmentation is a shortest path, and a chunk of the text acts on it as a max-plus matrix: a row for each number of
characters by which a piece reaches into the chunk, a column for each number by which one reaches out of it. A
matrix holds the best sums between such states; products of matrices are associative, so the chunks of one text
can be reduced in any grouping. The products up to each boundary give every chunk the best sums of its entering
states; with these each chunk finds by itself from which state a path to each leaving state comes; these maps, put
together from the end, give the states of the best path, and each chunk is then traced by itself. Scores are whole
numbers in the file at hand and sums start anew in each chunk, so they are exact and cutting changes no id.

Documents longer than `Params.chunk` characters are cut into chunks that are rows of their own, so a giant text
is spread over tasks for the matrices and again for the maps and traces; what is gathered for a text is a matrix
of at most 16 x 16 numbers a chunk. Other documents are one chunk, whose states are 0 at both ends.

Edge cases: null and empty texts have no ids and decode to an empty text. Repeated rows are encoded one by one.
A null doc_id is kept. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from scriptloom.session import written

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)  # piece types of the file format
PENALTY = 10.0
# letters, but not the digits and fractions that Python counts as word characters
LETTER = "[^\\W\\d_²³¹¼-¾]"
UNITS = re.compile(f"{SPACE}*(?:{LETTER}+|(?:[\\d_²³¹¼-¾]|[^\\w{SPACE}])+)|{SPACE}+")
LIMIT = 700_000  # words remembered


@dataclass(frozen=True)
class Params:
    chunk: int = 65_536  # characters of a chunk


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces_of(path: str) -> list[tuple[str, float, int]]:
    """(piece, score, type) by id, from the fields 1 of the model message."""
    raw, out, at = open(path, "rb").read(), [], 0

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (raw[at] & 127) << shift
            shift, at = shift + 7, at + 1
            if raw[at - 1] < 128:
                return value, at

    def field(at: int) -> tuple[int, object, int]:
        tag, at = number(at)
        if tag & 7 == 0:
            value, at = number(at)
            return tag >> 3, value, at
        if tag & 7 == 2:
            size, at = number(at)
            return tag >> 3, (at, at + size), at + size
        size = 4 if tag & 7 == 5 else 8
        return tag >> 3, raw[at:at + size], at + size

    while at < len(raw):
        key, value, at = field(at)
        if key != 1:
            continue
        piece, score, kind, p = "", 0.0, NORMAL, value[0]
        while p < value[1]:
            k, v, p = field(p)
            if k == 1:
                piece = raw[v[0]:v[1]].decode()
            elif k == 2:
                score = float(np.frombuffer(v, "<f4")[0])
            elif k == 3:
                kind = v
        out.append((piece, score, kind))
    return out


class Encoder:
    def __init__(self, path: str):
        table = pieces_of(path)
        self.pieces = {p: i for i, (p, _, kind) in enumerate(table) if kind in (NORMAL, USER)}
        self.score = {p: table[i][1] for p, i in self.pieces.items()}
        self.raw = [bytes([int(p[1:-1], 16)]) if kind == BYTE else p.replace(SPACE, " ").encode() for p, _, kind in table]
        self.bytes = {int(p[1:-1], 16): i for i, (p, _, kind) in enumerate(table) if kind == BYTE}
        self.unknown = next(i for i, (_, _, kind) in enumerate(table) if kind == UNKNOWN)
        self.longest = max(map(len, self.pieces))
        self.missing = min(self.score.values()) - PENALTY
        # no piece reaches out of a unit (spaces with the letters, or with the other characters, after them)
        self.by_unit = all(len(UNITS.findall(p)) == 1 for p in self.pieces)
        self.starts = {p[:k] for p in self.pieces for k in range(1, len(p) + 1)}
        self.words: dict[str, bytes] = {}

    # ---- one chunk ----------------------------------------------------------------------------------------

    def edges(self, text: str, at: int):
        """(end, score) of the pieces that start at `at`, shortest first; one unknown character where none is that long."""
        found_one, end, limit = False, at + 1, min(len(text), at + self.longest)
        while end <= limit:
            part = text[at:end]
            if part not in self.starts:
                break
            s = self.score.get(part)
            if s is not None:
                found_one |= end == at + 1
                yield end, s
            end += 1
        if not found_one:
            yield at + 1, self.missing

    def matrix(self, text: str, size: int) -> np.ndarray:
        """Best sums from each state on the left to each on the right of the chunk text[:size].

        State k: a piece of the left (right) neighbour reaches k characters in (out). text goes on after the chunk as far
        as a piece can reach. Every path meets at the end of a unit, so from there on one row stands for all.
        """
        meet = next((m.end() for m in UNITS.finditer(text) if m.end() >= self.longest), size) if self.by_unit else size
        if meet < size:
            rest = self.sweep(text[meet:], size - meet, [0.0])[0][size - meet:]
            return self.wide_matrix(text[:meet], meet)[:, :1] + np.array(rest)[None, :]
        return self.wide_matrix(text, size)

    def wide_matrix(self, text: str, size: int) -> np.ndarray:
        """The same, all states side by side."""
        wide = self.longest
        best = np.full((wide, size + wide), -np.inf)
        for k in range(min(wide, size + 1)):
            best[k, k] = 0.0
        for k in range(size + 1, wide):
            best[k, k] = 0.0  # the chunk is shorter than the piece that reaches over it
        for at in range(size):
            here = best[:, at]
            if np.isneginf(here).all():
                continue
            for end, s in self.edges(text, at):
                np.maximum(best[:, end], here + s, out=best[:, end])
        return best[:, size:size + wide]

    def sweep(self, text: str, size: int, enter: list[float]) -> tuple[list[float], list[int]]:
        """Best sum of each place of the chunk and of those a piece reaches behind it, and where its last piece starts
        (-1: before the chunk)."""
        longest, starts, score = self.longest, self.starts, self.score
        none, limit = -np.inf, len(text)
        best, back = [none] * (size + longest), [-1] * (size + longest)
        best[:len(enter)] = enter
        for at in range(size):
            here = best[at]
            if here == none:
                continue
            end, found_one = at + 1, False
            while end <= limit and end - at <= longest:
                part = text[at:end]
                if part not in starts:
                    break
                if part in score:
                    found_one |= end == at + 1
                    if here + score[part] > best[end]:  # equal sums keep the earlier start, the longer piece
                        best[end], back[end] = here + score[part], at
                end += 1
            if not found_one and here + self.missing > best[at + 1]:
                best[at + 1], back[at + 1] = here + self.missing, at
        return best, back

    def entered(self, text: str, size: int, enter: list[float]) -> list[int]:
        """For each leaving state, the entering state of the best path to it (-1: none)."""
        best, back = self.sweep(text, size, enter)
        out = []
        for at in range(size, size + self.longest):
            if best[at] == -np.inf:
                out.append(-1)
                continue
            while back[at] >= 0:
                at = back[at]
            out.append(at)
        return out

    def trace(self, text: str, size: int, enter: list[float], right: int) -> list[tuple[int, int]]:
        """(start, end) of the pieces that start in the chunk on the best path to a leaving state."""
        back, out, at = self.sweep(text, size, enter)[1], [], size + right
        while back[at] >= 0:
            out.append((back[at], at))
            at = back[at]
        return out[::-1]

    def ids_of(self, text: str, spans: list[tuple[int, int]]) -> list[int]:
        out = []
        for a, b in spans:
            i = self.pieces.get(text[a:b])
            if i is not None:
                out.append(i)
            elif self.bytes:
                out += [self.bytes[x] for x in text[a:b].encode("utf-8", "surrogatepass")]
            else:
                out.append(self.unknown)
        return out

    # ---- whole texts --------------------------------------------------------------------------------------

    @staticmethod
    def normal(text: str | None) -> str:
        return (SPACE + text.replace(" ", SPACE)) if text else ""

    def encode(self, text: str | None) -> bytes:
        """Ids (little-endian, 32 bits) of a text taken as one chunk; its units are traced once each."""
        whole = self.normal(text)
        if not self.by_unit:
            return packed(self.ids_of(whole, self.trace(whole, len(whole), [0.0], 0)))
        known, found = self.words, UNITS.findall(whole)
        if len(known) > LIMIT:
            known = self.words = {}
        new = {w for w in found if w not in known}
        for w in new:
            known[w] = packed(self.ids_of(w, self.trace(w, len(w), [0.0], 0)))
        out = b"".join([known[w] for w in found])
        for w in [w for w in new if len(w) > 64]:
            del known[w]
        return out

    def decode(self, ids: bytes) -> str:
        """The text of packed ids, less the space that normalisation put in front."""
        pieces = self.raw
        return b"".join([pieces[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "surrogatepass")[1:]


def packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def entering(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """Best sums of the entering states of each chunk, less their largest: max-plus products from the left."""
    out = [np.where(np.arange(len(matrices[0])) == 0, 0.0, -np.inf)]
    for m in matrices[:-1]:
        v = (out[-1][:, None] + m).max(0)
        out.append(v - v.max())
    return out


def leaving(maps: list[list[int]]) -> list[int]:
    """Leaving state of each chunk on the best path, which ends in state 0."""
    out = [0]
    for m in maps[:0:-1]:
        out.append(int(m[out[-1]]))
    return out[::-1]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(documents: DataFrame, path: str | None = None, p: Params = Params(), digest: bool = False) -> DataFrame:
    """doc_id, n_ids, ids_crc32, round_trip (the ids decode to the text) and, unless digest, ids of every document."""
    path = path or model_path()
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = "doc_id bigint, n_ids bigint, ids_crc32 bigint, round_trip boolean" + ("" if digest else ", ids array<int>")
    long = F.coalesce(F.length("text"), F.lit(0)) >= p.chunk  # with the leading space more than one chunk

    def row(enc: Encoder, doc_id, ids: bytes, text_crc: int) -> tuple:
        same = zlib.crc32(enc.decode(ids).encode("utf-8", "surrogatepass")) == text_crc
        return (doc_id, len(ids) // 4, zlib.crc32(ids), same) + (() if digest else (np.frombuffer(ids, "<i4"),))

    def frame(found: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(found, columns=[c.split()[0] for c in schema.split(", ")])
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    def crc(text: str | None) -> int:
        return zlib.crc32((text or "").encode("utf-8", "surrogatepass"))

    def short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at:at + 256]
                yield frame([row(enc, d, enc.encode(t), crc(t)) for d, t in
                             zip(part["doc_id"].tolist(), (t if isinstance(t, str) else None for t in part["text"]), strict=True)])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wide = encoder(path).longest
        for batch in batches:
            for doc_id, number, text in zip(batch["doc_id"].tolist(), batch["_row"], batch["text"], strict=True):
                whole, text_crc = Encoder.normal(text), crc(text)
                for k, at in enumerate(range(0, len(whole), p.chunk)):
                    part = whole[at:at + p.chunk + wide]
                    out = pd.DataFrame({"doc_id": [doc_id], "_row": number, "k": k, "size": min(p.chunk, len(whole) - at),
                                        "part": part, "text_crc": text_crc})
                    out["doc_id"] = out["doc_id"].astype("Int64")
                    yield out

    numbered = written(rows.filter(long).withColumn("_row", F.monotonically_increasing_id()), "giant-texts")
    chunks = written(numbered.mapInPandas(cut, "doc_id bigint, _row bigint, k int, size int, part string, text_crc bigint"), "giant-chunks")

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for batch in batches:
            yield pd.DataFrame({"_row": batch["_row"], "k": batch["k"], "matrix": [
                enc.matrix(t, n).tobytes() for t, n in zip(batch["part"], batch["size"], strict=True)]})

    def enter(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("k")
        side = encoder(path).longest
        found = entering([np.frombuffer(m, "<f8").reshape(side, side) for m in group["matrix"]])
        return pd.DataFrame({"_row": key[0], "k": group["k"], "enter": [v.tolist() for v in found]})

    def reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for batch in batches:
            yield batch[["_row", "k"]].assign(came=[
                enc.entered(t, n, list(v)) for t, n, v in zip(batch["part"], batch["size"], batch["enter"], strict=True)])

    def leave(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("k")
        return pd.DataFrame({"_row": key[0], "k": group["k"], "right": leaving(list(group["came"]))})

    def follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for batch in batches:
            ids = [packed(enc.ids_of(t, enc.trace(t, n, list(v), b)))
                   for t, n, v, b in zip(batch["part"], batch["size"], batch["enter"], batch["right"], strict=True)]
            yield batch[["doc_id", "_row", "k", "text_crc"]].assign(ids=ids)

    def gather(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("k")
        doc_id = group["doc_id"].iloc[0]
        return frame([row(encoder(path), None if pd.isna(doc_id) else int(doc_id), b"".join(group["ids"]), int(group["text_crc"].iloc[0]))])

    # the chunks of one text go to tasks of their own, for the matrices, the maps and the traces
    dealt = chunks.repartition(F.col("_row"), F.col("k"))
    matrices = dealt.select("_row", "k", "size", "part").mapInPandas(measure, "_row bigint, k int, matrix binary")
    starts = matrices.groupBy("_row").applyInPandas(enter, "_row bigint, k int, enter array<double>")
    entered = written(chunks.join(starts, ["_row", "k"]), "giant-entered")
    maps = entered.repartition(F.col("_row"), F.col("k")).select("_row", "k", "size", "part", "enter") \
        .mapInPandas(reach, "_row bigint, k int, came array<int>")
    ends = maps.groupBy("_row").applyInPandas(leave, "_row bigint, k int, right int")
    traced = entered.join(ends, ["_row", "k"]).mapInPandas(
        follow, "doc_id bigint, _row bigint, k int, text_crc bigint, ids binary")
    giant = traced.groupBy("_row").applyInPandas(gather, schema)
    return rows.filter(~long).mapInPandas(short, schema).unionByName(giant)


def decoded(rows: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text of rows with doc_id, ids (array)."""
    path = path or model_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text": [
                enc.decode(packed(list(i))) if i is not None else "" for i in batch["ids"]]})

    return rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids").mapInPandas(run, "doc_id bigint, text string")
