"""Token files: frequency-ranked ids, variable length, with separate control bytes.

All texts are encoded once, into a table of raw ids that stays until the files are written.
The ids are counted in it; the most frequent id becomes rank 0, so common ids take one
byte. Ranks are written with 1 to 4 whole bytes each; their lengths stand apart, two bits
per id, four to a control byte, and are expanded by table look-up with NumPy on reading.

A file holds a run of documents in ascending ``doc_id`` order (null first, rows with equal
ids by text hash); files follow each other. Layout, little-endian: magic ``TLTK0001``,
documents u64, ids u64, data bytes u64; per document doc_id i64; a byte that is 1 where
doc_id is null; ids u32; then all control bytes (a document begins with a new one), then
all data bytes. The ranks are a table beside the files: ``rank, id, n``.

Encoding remembers the ids of words. A text is cut at single spaces and line ends between
other characters: a token of byte-level BPE with the usual pattern never crosses such a
place, and neither does a special token. Words are cut, hashed and looked up in NumPy, a
slice of texts at a time; a remembered word is its hash, its length and first bytes (both
compared) and its ids, some 40 bytes. Texts with other white space are cut more warily,
one by one.

Defined cases: a null or empty text has the end id only; repeated rows are written each;
other columns are not read; an empty table gives no files and no rows.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tasteloom.llm.base import saved, scratch, slices
from tasteloom.llm.files import opened, written
from tasteloom.llm.words import SPACED, words

MAGIC = b"TLTK0001"
END_ID = 0
#: Text bytes that one file is made of, about.
FILE_BYTES = 32 << 20
#: Ids decoded at once, or one document's.
PIECE = 1 << 18
#: Words that a worker remembers, and bytes of pieces of texts with other white space, about;
#: then it starts anew.
REMEMBERED_WORDS = 1 << 20
REMEMBERED = 16 << 20
#: What a remembered piece takes besides its characters.
_PIECE_BYTES = 200
#: Text bytes that are encoded at once.
_SLICE = 1 << 20
#: What stands before a word: the text's begin, a space or a line end.
_FIRST, _SPACE, _LINE = 0, 1, 2
#: Bytes that hold a word's first ones.
_HEAD = 8
#: ASCII characters that are no letters, digits or spaces: a run of them behind a word is one
#: match of the pattern. The apostrophe may begin other ones.
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
#: Letters below this one (Latin, Greek, Cyrillic) are letters in every version of Unicode here.
_SURE = "\u0530"
#: Marks a piece that has no space before it; such a character in a text rules the mark out.
_BARE = "\x00"


def _byte_letters() -> list[str]:
    """The letter that byte-level BPE writes for every byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def _one_match(core: str) -> bool:
    """Whether a text without spaces is one run of letters, or of digits."""
    if core.isascii():
        return core.isalpha() or core.isdigit()
    return core.isalpha() and max(core) < _SURE


class _Known:
    """Ids of words by their 64-bit hash. New ones go into a small sorted part that is merged
    into the large one when it has grown to an eighth of that."""

    def __init__(self, dtype: np.dtype):
        empty = np.zeros(0, np.uint64)
        self.parts = [(empty, empty, np.zeros(0, np.int64))] * 2
        self.flat = np.zeros(1 << 16, dtype)
        self.starts = np.zeros(1 << 12, np.int64)
        self.n = 0

    def find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """The number of every key, -1 if it is not known; ``keys`` are sorted.

        A word whose hash is that of another one is never found, so it is encoded each time.
        """
        found = np.full(len(keys), -1)
        for names, marks, numbers in self.parts:
            if len(names):
                at = np.minimum(np.searchsorted(names, keys), len(names) - 1)
                same = (names[at] == keys) & (marks[at] == checks)
                found[same] = numbers[at[same]]
        return found

    def add(self, keys: np.ndarray, checks: np.ndarray, ids: list[list[int]]) -> np.ndarray:
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        total, used = int(lengths.sum()), int(self.starts[self.n])
        while used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n + len(ids) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.flat[used : used + total] = [i for one in ids for i in one]
        self.starts[self.n + 1 : self.n + 1 + len(ids)] = used + np.cumsum(lengths)
        numbers = np.arange(self.n, self.n + len(ids))
        self.n += len(ids)
        large, small = self.parts
        small = self._merged(small, (keys, checks, numbers))
        if len(small[0]) * 8 > len(large[0]):
            large, small = self._merged(large, small), tuple(c[:0] for c in small)
        self.parts = [large, small]
        return numbers

    @staticmethod
    def _merged(a: tuple, b: tuple) -> tuple:
        joined = [np.concatenate(c) for c in zip(a, b)]
        order = np.argsort(joined[0], kind="stable")
        return tuple(c[order] for c in joined)

    def spans(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words one after the other, and how many each has."""
        starts = self.starts[numbers]
        lengths = self.starts[numbers + 1] - starts
        ends = np.cumsum(lengths)
        at = np.arange(int(ends[-1]) if len(ends) else 0)
        at += np.repeat(starts - (ends - lengths), lengths)
        return self.flat[at], lengths


class Encoder:
    """A tokenizer file, with the ids of the words seen so far in one flat array."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.table = dict(enumerate(_byte_letters()))
        self.marks: dict[str, list[int]] = {}
        self.words = _Known(self.dtype)
        self.known: dict[str, list[int]] = {}
        self.bytes = 0
        self.line = self.tokenizer.encode("\n", add_special_tokens=False).ids

    def _model_ids(self, part: str) -> list[int]:
        """One match of the pattern: the model alone, without the pattern."""
        part = part.encode().decode("latin-1").translate(self.table)
        return [t.id for t in self.model.tokenize(part)]

    def _ids(self, word: str, space: bool) -> list[int]:
        """The ids of a piece, with a space before it or not."""
        whole = " " + word if space else word
        if _one_match(word):
            return self._model_ids(whole)
        core = word.rstrip(_MARKS)
        if core != word and core.isalpha() and _one_match(core):
            marks = word[len(core) :]
            if marks not in self.marks:
                if len(self.marks) > 10_000:
                    self.marks.clear()
                self.marks[marks] = self._model_ids(marks)
            return self._model_ids(" " + core if space else core) + self.marks[marks]
        return self.tokenizer.encode(whole, add_special_tokens=False).ids

    def _usual_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that are ``_usual``, and the number of ids of each."""
        found = words(texts, SPACED)
        first = np.zeros(len(found.starts), bool)
        first[found.rows[:-1][np.diff(found.rows) > 0]] = True
        before = found.data[found.starts - 1] if len(found.data) else found.starts
        kind = np.where(first, _FIRST, np.where(before == 10, _LINE, _SPACE))
        keys = found.hashes + kind.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        keys, at, which = np.unique(keys, return_index=True, return_inverse=True)
        checks = _checks(found.data, found.starts[at], found.ends[at])
        if self.words.n > REMEMBERED_WORDS:
            self.words = _Known(self.dtype)
        numbers = self.words.find(keys, checks)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            raw = found.data.tobytes()
            ids = []
            for i, begin, end in zip(
                kind[at[new]].tolist(), found.starts[at[new]].tolist(), found.ends[at[new]].tolist()
            ):
                own = self._ids(raw[begin:end].decode(), i == _SPACE)
                ids.append([*self.line, *own] if i == _LINE else own)
            numbers[new] = self.words.add(keys[new], checks[new], ids)
        out, lengths = self.words.spans(numbers[which])
        sums = np.concatenate([[0], np.cumsum(lengths)])
        return out, np.diff(sums[found.rows])

    def _other_ids(self, text: str) -> np.ndarray:
        """Ids of a text with other white space, piece by piece."""
        if self.bytes > REMEMBERED:
            self.known.clear()
            self.bytes = 0
        ids: list[int] = []
        for piece in cut(text):
            if piece not in self.known:
                bare = piece[:1] == _BARE
                self.known[piece] = self._ids(piece[1:] if bare else piece, not bare)
                self.bytes += _PIECE_BYTES + len(piece)
            ids += self.known[piece]
        return np.array(ids, self.dtype)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the number of ids of each text."""
        usual = np.fromiter((not text or _usual(text) for text in texts), bool, len(texts))
        plain = texts if usual.all() else [t if u else "" for t, u in zip(texts, usual)]
        ids, n = self._usual_ids(pa.array(plain, pa.large_string()))
        if plain is texts:
            return ids, n
        rows = np.split(ids, np.cumsum(n)[:-1])
        for i in np.flatnonzero(~usual).tolist():
            rows[i] = self._other_ids(texts[i])
        return np.concatenate(rows), np.fromiter(map(len, rows), np.int64, len(rows))


def _checks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A word's length and first bytes in one number, beside its hash."""
    padded = np.concatenate([data, np.zeros(_HEAD, np.uint8)])
    head = padded[starts[:, None] + np.arange(_HEAD)]
    size = ends - starts
    head[np.arange(_HEAD) >= size[:, None]] = 0
    return head.view("<u8").ravel() ^ (size.astype(np.uint64) << np.uint64(56))


def _usual(text: str) -> bool:
    """Only single spaces and line ends, each between other characters."""
    return (
        text.replace("\n", "").isprintable()  # no other white space is printable
        and not any(two in text for two in ("  ", " \n", "\n ", "\n\n"))
        and text[0] not in " \n"
        and text[-1] not in " \n"
    )


def cut(text: str) -> list[str]:
    """Pieces that no token crosses. A piece stands for itself with a space before it, or,
    marked, for what follows the mark."""
    if _BARE in text:
        return [_BARE + text]
    parts = text.split(" ")
    out = [_BARE + parts[0]]
    for part in parts[1:]:
        # A space that white space follows belongs to the piece before.
        if part and not part[0].isspace():
            out.append(part)
        else:
            out[-1] += " " + part
    return out


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """Kept by the worker from task to task."""
    return Encoder(path)


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Rows of bytes that follow each other in ``data``."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())]
    )


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The data of a binary column, and the row offsets in it."""
    column = column.cast(pa.large_binary())
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def encoded(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """``doc_id, tie, n, ids`` with the ids and the end id as little-endian numbers."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer)
        for batch in slices(batches, most=_SLICE):
            ids, n = code.encode([text or "" for text in batch.column(2).to_pylist()])
            ids = np.insert(ids, np.cumsum(n), end_id)
            rows = _binary(ids, (n + 1) * code.dtype.itemsize)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(n + 1, pa.int64()), rows],
                ["doc_id", "tie", "n", "ids"],
            )

    return docs.select("doc_id", F.xxhash64("text").alias("tie"), "text").mapInArrow(
        step, "doc_id bigint, tie bigint, n bigint, ids binary"
    )


def id_counts(encoded_docs: DataFrame) -> DataFrame:
    """``id, n`` over all documents; a task gives one row per id."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            raw, offsets = _bytes(batch.column(1))
            width = int(offsets[-1]) // max(1, int(np.sum(batch.column(0).to_numpy())))
            counts = np.bincount(raw.view(f"<u{width}") if len(raw) else [], minlength=len(total))
            counts[: len(total)] += total
            total = counts
        ids = np.flatnonzero(total)
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], ["id", "n"])

    part = encoded_docs.select("n", "ids").mapInArrow(step, "id bigint, n bigint")
    return part.groupBy("id").agg(F.sum("n").alias("n"))


#: The four lengths that a control byte stands for.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def _slots(n: np.ndarray) -> np.ndarray:
    """Which of the slots of the control bytes hold an id, row after row."""
    groups = -(-n // 4)
    ends = np.cumsum(groups * 4)
    at = np.arange(int(ends[-1]) if len(n) else 0) - np.repeat(ends - groups * 4, groups * 4)
    return at < np.repeat(n, groups * 4)


def packed(ranks: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Control bytes, data bytes, and how many data bytes each row of ``n`` ranks takes."""
    ranks = ranks.astype("<u4")
    size = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    used = _slots(n)
    four = np.zeros(len(used), np.uint8)
    four[used] = size
    four = four.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= size[:, None]]
    sums = np.concatenate([[0], np.cumsum(size, dtype=np.int64) + np.arange(1, len(size) + 1)])
    return control, data, np.diff(sums[np.concatenate([[0], np.cumsum(n)])])


def unpacked(control: np.ndarray, data: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The ranks of rows of ``n`` ranks each."""
    lengths = LENGTHS[control].ravel()[_slots(n)]
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    wide = np.zeros(len(data) + 3, np.uint32)
    wide[: len(data)] = data
    out = wide[starts]
    for i in (1, 2, 3):
        out |= wide[starts + i] << np.uint32(8 * i)
    return out & _MASKS[lengths]


def data_size(control: np.ndarray, n: np.ndarray) -> int:
    return int(LENGTHS[control].ravel()[_slots(n)].sum(dtype=np.int64))


@dataclass(frozen=True)
class TokenFiles:
    """The files of one run: ``manifest`` has their order, ``ranks`` their ids."""

    folder: str

    def manifest(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(MANIFEST).parquet(f"{self.folder}/manifest")

    def ranks(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("rank bigint, id bigint, n bigint").parquet(f"{self.folder}/ranks")


MANIFEST = "path string, part int, n_docs bigint, n_tokens bigint, n_bytes bigint"


def write(
    docs: DataFrame, tokenizer: str, end_id: int = END_ID, file_bytes: int = FILE_BYTES
) -> TokenFiles:
    spark = docs.sparkSession
    out = TokenFiles(scratch(spark, "tokens"))
    path = f"{out.folder}/encoded"
    found = encoded(docs, tokenizer, end_id)
    found.write.option("compression", "zstd").parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    # At most one row for each id of the tokenizer, so one task and the driver can hold them.
    order = Window.orderBy(F.desc("n"), F.asc("id"))
    ranked = id_counts(found).select(
        (F.row_number().over(order) - 1).cast("bigint").alias("rank"), "id", "n"
    )
    ranks = saved(ranked, f"{out.folder}/ranks").orderBy("rank").collect()
    to_rank = np.zeros(max((r["id"] for r in ranks), default=0) + 1, np.uint32)
    to_rank[[r["id"] for r in ranks]] = [r["rank"] for r in ranks]
    shared = spark.sparkContext.broadcast(to_rank)
    total = sum(r["n"] for r in ranks)
    folder = f"{out.folder}/files"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            raw, offsets = _bytes(batch.column(3))
            n = batch.column(2).to_numpy()
            width = int(offsets[-1]) // max(1, int(n.sum()))
            control, data, sizes = packed(table[raw.view(f"<u{width}")] if len(raw) else raw, n)
            yield pa.record_batch(
                [*batch.columns[:3], _binary(control, -(-n // 4)), _binary(data, sizes)],
                ["doc_id", "tie", "n", "control", "data"],
            )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        docs_, nulls, lengths, controls, datas = [], [], [], [], []
        for batch in batches:
            column = batch.column(0)
            nulls.append(column.is_null().to_numpy(zero_copy_only=False).astype(np.uint8))
            docs_.append(column.fill_null(0).to_numpy().astype("<i8"))
            lengths.append(batch.column(1).to_numpy().astype("<u4"))
            controls.append(_bytes(batch.column(2))[0])
            datas.append(_bytes(batch.column(3))[0])
        n_docs = sum(map(len, docs_))
        if not n_docs:
            return
        n_tokens = int(sum(x.sum(dtype=np.int64) for x in lengths))
        counts = np.array([n_docs, n_tokens, sum(map(len, datas))], "<u8")
        body = [counts, *docs_, *nulls, *lengths, *controls, *datas]
        parts = [MAGIC, *(x.tobytes() for x in body)]
        path = written(folder, f"{part:06d}.tok", iter(parts))
        yield pa.record_batch(
            [[path], pa.array([part], pa.int32()), [n_docs], [n_tokens], [sum(map(len, parts))]],
            ["path", "part", "n_docs", "n_tokens", "n_bytes"],
        )

    schema = "doc_id bigint, tie bigint, n bigint, control binary, data binary"
    # About 2.5 bytes of text to a token.
    files = -(-total * 5 // (file_bytes * 2)) or 1
    (
        found.mapInArrow(pack, schema)
        .repartitionByRange(files, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "n", "control", "data")
        .mapInArrow(step, MANIFEST)
        .write.parquet(f"{out.folder}/manifest")
    )
    return out


def pieces(path: str, to_id: np.ndarray) -> Iterator[tuple]:
    """``(doc_ids, nulls, lengths, ids)`` of some documents at a time."""
    with opened(path) as file:
        if file.read(8) != MAGIC:
            raise ValueError(f"{path} is no token file")
        n_docs, n_tokens, n_data = map(int, np.frombuffer(file.read(24), "<u8"))
        docs = np.frombuffer(file.read(8 * n_docs), "<i8")
        nulls = np.frombuffer(file.read(n_docs), np.uint8).astype(bool)
        lengths = np.frombuffer(file.read(4 * n_docs), "<u4").astype(np.int64)
        control_at = file.tell()
        data_at = control_at + int((-(-lengths // 4)).sum())
        ends = np.cumsum(lengths)
        first = 0
        while first < n_docs:
            before = ends[first] - lengths[first]
            last = max(int(np.searchsorted(ends, before + PIECE, side="right")), first + 1)
            n = lengths[first:last]
            file.seek(control_at)
            control = np.frombuffer(file.read(int((-(-n // 4)).sum())), np.uint8)
            file.seek(data_at)
            data = np.frombuffer(file.read(data_size(control, n)), np.uint8)
            control_at += len(control)
            data_at += len(data)
            yield docs[first:last], nulls[first:last], n, to_id[unpacked(control, data, n)]
            first = last


def read(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    ranks = files.ranks(spark).orderBy("rank").collect()
    shared = spark.sparkContext.broadcast(np.array([r["id"] for r in ranks], np.uint32))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    listed = files.manifest(spark).select(
        "path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first")
    )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_id = shared.value
        for batch in batches:
            for path, first in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                for docs, nulls, n, ids in pieces(path, to_id):
                    ends = np.cumsum(n)
                    raw = ids.astype("<u4")
                    sums = [zlib.crc32(raw[a:b]) for a, b in zip(ends - n, ends, strict=True)]
                    yield pa.record_batch(
                        [
                            pa.array(docs, pa.int64(), mask=nulls),
                            pa.array(first + ends - n, pa.int64()),
                            pa.array(n, pa.int64()),
                            pa.array(sums, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                    first += int(ends[-1])

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    n = max(1, files.manifest(spark).count())
    return listed.repartition(n, "path").mapInArrow(step, schema)
