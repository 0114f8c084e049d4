"""Substring dedup with suffix automata of reference shards.

A window is ``WINDOW`` consecutive words. Words of a document are removed if a window that
covers them also starts in a document with a smaller id. The reference is every repeated
window once, in the document where it first occurs, as maximal passages. Passages are dealt
out to shards of about ``SHARD_WORDS`` words. A task builds the suffix automaton of a shard;
documents stream through it and their matching statistics tell, word by word, how long a
stretch ending there the shard holds and which document held it first. Stretches of a window
or more from a smaller id are removed.

A corpus is its own reference, so sending every shard to every document would cost its square.
A document goes only to shards that hold a window of it. These are found in three steps:

* Anchors: in every run of ``WINDOW - GRAM + 1`` word grams the least hash is an anchor
  (winnowing), so equal windows have an anchor in common. Anchors of one text only are left out.
* The windows around repeated anchors are hashed; the first document of each is an aggregate.
* Documents are paired with the shards of their windows' first documents.

Texts that are equal as word sequences are one class with its smallest id; the others of a
class are removed whole, if they have a window, and need no search.

Hot passages: firsts are aggregates with map-side combination; documents of one shard are
dealt to groups of ``GROUP_WORDS`` words each with its own copy of the automaton; texts are
shuffled only for documents that have matches (a filter of fixed size, then an exact join).

Defined cases: null or empty texts have no words; rows with a null ``doc_id`` are neither
reference nor changed; repeated rows have equal ids, so they take nothing from each other;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.llm import words as W
from tasteloom.llm.base import arrow_map, saved, scratch
from tasteloom.llm.ids import id_filter, passing, rows_passing, with_slot

WINDOW = 50
GRAM = 14
#: Words of reference passages in a shard, about; and words that stream through one copy.
SHARD_WORDS = 20_000
GROUP_WORDS = 400_000


def _sliding(values: np.ndarray, k: int, take) -> np.ndarray:
    """``take`` (minimum or maximum) over every run of ``k`` values."""
    if len(values) < k:
        return values[:0]
    out, width = values, 1
    while width * 2 <= k:
        out = take(out[:-width], out[width:])
        width *= 2
    rest = k - width
    return take(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(hashes: np.ndarray, rows: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and word positions of the anchors of all rows."""
    grams = W.grams(hashes, gram)
    span = window - gram + 1
    least = _sliding(grams, span, np.minimum)
    if not len(least):
        return grams[:0], np.zeros(0, np.int64)
    inside = W.inside_rows(rows, window)[: len(least)]
    # A gram is chosen if it is the least of some window that lies within its row.
    least = np.where(inside, least, 0)
    padded = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
    best = _sliding(padded, span, np.maximum)[: len(grams)]
    at = np.flatnonzero(best == grams)
    return grams[at], at


def _class(hashes: np.ndarray) -> int:
    raw = hashlib.blake2b(hashes.tobytes(), digest_size=8).digest()
    return int.from_bytes(raw, "little", signed=True)


def _rows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """``doc_id, cls, n_words, anchors`` of every row with an id; distinct anchors."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = W.words(batch.column(1), W.SPACED)
        grams, at = anchors(found.hashes, found.rows, window, gram)
        limits = np.searchsorted(at, found.rows)
        lists = [np.unique(grams[a:b]) for a, b in zip(limits[:-1], limits[1:], strict=True)]
        ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
        flat = np.concatenate(lists) if lists else np.zeros(0, np.uint64)
        cls = [_class(found.hashes[a:b]) for a, b in zip(found.rows[:-1], found.rows[1:], strict=True)]
        return pa.record_batch(
            [
                batch.column(0),
                pa.array(cls, pa.int64()),
                pa.array(found.counts(), pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64), pa.int64())),
            ],
            ["doc_id", "cls", "n_words", "anchors"],
        )

    schema = "doc_id bigint, cls bigint, n_words bigint, anchors array<bigint>"
    return arrow_map(docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "text"), step, schema)


def _windows(docs: DataFrame, flags: DataFrame, window: int, gram: int) -> DataFrame:
    """``h, doc, pos`` of the windows with a repeated anchor; ``flags`` is ``doc, anchors``."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = W.words(batch.column(1), W.SPACED)
        grams, at = anchors(found.hashes, found.rows, window, gram)
        limits = np.searchsorted(at, found.rows)
        flags = batch.column(2)
        flat, ends = flags.flatten().to_numpy().view(np.uint64), flags.offsets.to_numpy()
        ends = ends - ends[0]
        marks = np.zeros(len(found.hashes) + 1, np.int64)
        span = window - gram
        for i in range(batch.num_rows):
            a, b = limits[i], limits[i + 1]
            hit = at[a:b][np.isin(grams[a:b], flat[ends[i] : ends[i + 1]])]
            np.add.at(marks, np.maximum(hit - span, found.rows[i]), 1)
            np.add.at(marks, hit + 1, -1)
        near = (np.cumsum(marks[:-1]) > 0) & W.inside_rows(found.rows, window)
        start = np.flatnonzero(near)
        row = W.row_of(found.rows)[start]
        h = W.range_hashes(found.hashes, start, start + window).view(np.int64)
        return pa.record_batch(
            [
                pa.array(h, pa.int64()),
                batch.column(0).take(pa.array(row)),
                pa.array(start - found.rows[row], pa.int32()),
            ],
            ["h", "doc", "pos"],
        )

    bits = id_filter(flags, "doc")
    some = rows_passing(docs.select(F.col("doc_id").alias("doc"), "text"), "doc", bits)
    joined = some.join(flags, "doc").select("doc", "text", "anchors")
    return arrow_map(joined, step, "h bigint, doc bigint, pos int")


class Automaton:
    """Suffix automaton over several passages; every state knows the least document in it.

    Symbols are word hashes. A state stands for all its substrings; they occur in the same
    places, so the least document is one for all of them.
    """

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.least = [np.iinfo(np.int64).max]

    def add(self, passage: list[int], doc: int) -> None:
        nexts, link, length, least = self.next, self.link, self.length, self.least
        last = 0
        for c in passage:
            known = nexts[last].get(c)
            if known is not None:
                if length[known] == length[last] + 1:
                    last = known
                    least[known] = min(least[known], doc)
                    continue
                last = self._split(last, known, c)
                least[last] = min(least[last], doc)
                continue
            new = len(nexts)
            nexts.append({})
            length.append(length[last] + 1)
            link.append(0)
            least.append(doc)
            p = last
            while p >= 0 and c not in nexts[p]:
                nexts[p][c] = new
                p = link[p]
            if p >= 0:
                q = nexts[p][c]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, q, c)
            last = new

    def _split(self, p: int, q: int, c: int) -> int:
        nexts, link, length = self.next, self.link, self.length
        copy = len(nexts)
        nexts.append(nexts[q].copy())
        length.append(length[p] + 1)
        link.append(link[q])
        self.least.append(self.least[q])
        link[q] = copy
        while p >= 0 and nexts[p].get(c) == q:
            nexts[p][c] = copy
            p = link[p]
        return copy

    def finish(self) -> None:
        """What a state holds, the shorter suffixes that it links to hold too."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            up = self.link[state]
            if up > 0 and self.least[state] < self.least[up]:
                self.least[up] = self.least[state]

    def spans(self, text: list[int], doc: int, window: int) -> list[tuple[int, int]]:
        """Maximal stretches of ``text`` made of windows that a smaller document holds."""
        nexts, link, length, least = self.next, self.link, self.length, self.least
        state = matched = 0
        out: list[tuple[int, int]] = []
        for i, c in enumerate(text):
            to = nexts[state].get(c)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = nexts[state].get(c)
            if to is None:
                continue
            state = to
            matched += 1
            if matched < window:
                continue
            # The state of just the last ``window`` words.
            while length[link[state]] >= window:
                state = link[state]
                matched = length[state]
            if least[state] < doc:
                start = i + 1 - window
                if out and start <= out[-1][1]:
                    out[-1] = (out[-1][0], i + 1)
                else:
                    out.append((start, i + 1))
        return out


def _dealt(docs: DataFrame, info: DataFrame, window: int) -> DataFrame:
    """Rows for the shards: passages (``least`` true) and whole documents to stream.

    ``info`` is ``doc, firsts`` (starts of the windows that occur here first) and ``shards``
    (to stream through: structs of shard and number of groups) and ``own`` (its own shard).
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = W.words(batch.column(1), W.SPACED)
        docs_, firsts, shards, own = (batch.column(i).to_pylist() for i in (0, 2, 3, 4))
        out: dict[str, list] = {n: [] for n in ("shard", "part", "kind", "doc", "cls", "words")}

        def put(**row) -> None:
            for name, value in row.items():
                out[name].append(value)

        for i in range(batch.num_rows):
            hashes = found.hashes[found.rows[i] : found.rows[i + 1]]
            cls = _class(hashes)
            if firsts[i]:
                at = np.unique(np.array(firsts[i], np.int64))
                at = at[at + window <= len(hashes)]
                cuts = np.flatnonzero(np.diff(at) > 1) + 1 if len(at) else []
                for run in np.split(at, cuts) if len(at) else []:
                    passage = hashes[run[0] : run[-1] + window].tobytes()
                    for part in range(own[i]["groups"]):
                        put(shard=own[i]["shard"], part=part, kind=0, doc=docs_[i], cls=cls, words=passage)
            for one in shards[i] or []:
                part = cls % one["groups"]
                put(shard=one["shard"], part=part, kind=1, doc=docs_[i], cls=cls, words=hashes.tobytes())
        types = {"shard": pa.int32(), "part": pa.int32(), "kind": pa.int32(), "words": pa.binary()}
        return pa.record_batch([pa.array(v, types.get(n, pa.int64())) for n, v in out.items()], list(out))

    bits = id_filter(info, "doc")
    some = rows_passing(docs.select(F.col("doc_id").alias("doc"), "text"), "doc", bits)
    joined = some.join(info, "doc").select("doc", "text", "firsts", "shards", "own")
    return arrow_map(
        joined, step, "shard int, part int, kind int, doc bigint, cls bigint, words binary"
    )


def _matched(dealt: DataFrame, window: int) -> DataFrame:
    """``doc, cls, start, end``: what the automata of the shards find."""

    schema = "doc bigint, cls bigint, start bigint, end bigint"

    def step(rows: pa.Table) -> pa.Table:
        out: list[list[int]] = [[], [], [], []]
        refs = rows.filter(pc.equal(rows.column("kind"), 0))
        texts = rows.filter(pc.equal(rows.column("kind"), 1))
        if len(refs) and len(texts):
            automaton = Automaton()
            for doc, words in zip(refs.column("doc").to_pylist(), refs.column("words"), strict=True):
                automaton.add(np.frombuffer(words.as_buffer(), np.uint64).tolist(), doc)
            automaton.finish()
            docs, classes = (texts.column(c).to_pylist() for c in ("doc", "cls"))
            for doc, cls, words in zip(docs, classes, texts.column("words"), strict=True):
                text = np.frombuffer(words.as_buffer(), np.uint64).tolist()
                for a, b in automaton.spans(text, doc, window):
                    for column, value in zip(out, (doc, cls, a, b), strict=True):
                        column.append(value)
        return pa.table([pa.array(c, pa.int64()) for c in out], ["doc", "cls", "start", "end"])

    return dealt.groupBy("shard", "part").applyInArrow(step, schema)


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc, cls, spans`` for every document text to cut; a whole text has one span."""
    folder = scratch(docs.sparkSession, "substrings")
    rows = saved(_rows(docs, window, gram), f"{folder}/rows")
    facts = rows.select("doc_id", "cls", "n_words")
    long = facts.filter(F.col("n_words") >= window)
    classes = saved(
        long.groupBy("cls").agg(F.min("doc_id").alias("doc"), F.max("n_words").alias("n_words")),
        f"{folder}/classes",
    )

    per_class = rows.filter(F.col("n_words") >= window).select("cls", F.explode("anchors").alias("h"))
    repeated = (
        per_class.groupBy("h").agg(F.min("cls").alias("a"), F.max("cls").alias("b")).filter("a <> b")
    )
    # Only the first document of a class goes on, so a copied text counts once.
    of_first = rows.join(
        classes.select(F.col("cls").alias("_c"), F.col("doc").alias("_d")),
        (F.col("cls") == F.col("_c")) & (F.col("doc_id") == F.col("_d")),
    ).select(F.col("doc_id").alias("doc"), F.explode("anchors").alias("h"))
    flags = saved(
        of_first.join(repeated.select("h"), "h", "left_semi")
        .groupBy("doc")
        .agg(F.collect_set("h").alias("anchors")),
        f"{folder}/flags",
    )

    windows = saved(_windows(docs, flags, window, gram), f"{folder}/windows")
    firsts = windows.groupBy("h").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    firsts = firsts.filter("first <> last").select("h", "first")
    traced = windows.join(firsts, "h")
    here = saved(
        traced.filter(F.col("doc") == F.col("first"))
        .groupBy("doc")
        .agg(F.collect_set("pos").alias("firsts")),
        f"{folder}/firsts",
    )
    pairs = saved(
        traced.filter(F.col("doc") != F.col("first")).select("doc", "first").distinct(), f"{folder}/pairs"
    )

    n_words = here.agg(F.sum(F.size("firsts") + window)).first()[0] or 0
    shards = -(-n_words // SHARD_WORDS) or 1

    def shard(column: str):
        return F.pmod(F.xxhash64(column), F.lit(shards)).cast("int").alias("shard")

    routes = saved(pairs.select("doc", shard("first")).distinct(), f"{folder}/routes")
    sizes = classes.groupBy("doc").agg(F.max("n_words").alias("n_words"))
    loads = saved(
        routes.join(sizes, "doc")
        .groupBy("shard")
        .agg(F.ceil(F.sum("n_words") / GROUP_WORDS).cast("int").alias("groups")),
        f"{folder}/loads",
    )
    entry = F.struct("shard", "groups")
    streams = routes.join(loads, "shard").groupBy("doc").agg(F.collect_set(entry).alias("shards"))
    own = here.select("doc", "firsts", shard("doc")).join(loads, "shard").select(
        "doc", "firsts", entry.alias("own")
    )
    info = saved(own.join(streams, "doc", "full"), f"{folder}/info")
    found = saved(_matched(_dealt(docs, info, window), window), f"{folder}/found")

    copies = facts.filter(F.col("n_words") >= window).join(
        classes.select(F.col("cls").alias("_c"), F.col("doc").alias("_d")), F.col("cls") == F.col("_c")
    )
    whole = (
        copies.filter(F.col("doc_id") != F.col("_d"))
        .select(F.col("doc_id").alias("doc"), "cls", F.lit(0).cast("bigint").alias("start"), F.col("n_words").alias("end"))
        .distinct()
    )
    spans = F.collect_set(F.struct("start", "end")).alias("spans")
    return saved(found.unionByName(whole).groupBy("doc", "cls").agg(spans), f"{folder}/spans")


def _cut(words: list[bytes], spans: list[dict] | None) -> list[bytes]:
    if not spans:
        return words
    gone = np.zeros(len(words), bool)
    for span in spans:
        gone[span["start"] : span["end"]] = True
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def deduplicated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` of every row; kept words are joined by one space."""
    spans = repeated_spans(docs, window, gram)
    picked = docs.select("doc_id", "text")
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept string"

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        cut = batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * batch.num_rows
        found = W.words(batch.column(1), W.SPACED) if any(cut) else None
        n, removed, kept = [], [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            words = [w for w in (text or "").encode().translate(_TO_SPACE).split(b" ") if w]
            mine = None
            if cut[i]:
                cls = _class(found.hashes[found.rows[i] : found.rows[i + 1]])
                mine = [s for one in cut[i] if one["cls"] == cls for s in one["spans"]]
            left = _cut(words, mine)
            n.append(len(words))
            removed.append(len(words) - len(left))
            kept.append(b" ".join(left).decode())
        return pa.record_batch(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept"],
        )

    bits = id_filter(spans, "doc")
    by_doc = spans.groupBy("doc").agg(F.collect_list(F.struct("cls", "spans")).alias("cut"))
    some = rows_passing(picked, "doc_id", bits)
    some = some.join(by_doc, F.col("doc_id") == F.col("doc"), "left").select("doc_id", "text", "cut")
    untouched = with_slot(picked, "doc_id")
    return arrow_map(some, step, schema).unionByName(
        arrow_map(untouched, step, schema, first=passing(bits, False))
    )


_TO_SPACE = bytes(32 if b in W.SPACES else b for b in range(256))


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
