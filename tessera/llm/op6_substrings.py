"""Substring dedup: words covered by a window of WINDOW words whose sequence starts elsewhere too.

Shards with an FM-index each find the repeated windows. What a shard indexes is dealt so that equal
windows always meet:

1. The anchor of a window is the least hash of its runs of ANCHOR words; equal windows have equal
   anchors. Windows of a document that follow each other and have one anchor are a segment.
2. Anchors are counted over the whole corpus. A segment whose anchor no other segment has holds no
   repeated window. The other anchors make a filter of bounded size (some more may pass it), and so
   do the documents that have one: no other document is cut into words again.
3. Segments that pass go to the shard of their anchor, once (twice, if they occur again) for each
   task that meets them. Windows of an anchor that more than HOT segments have are dealt one by
   one, by the hash of the whole window, so that no shard gets all of a frequent phrase.
4. A shard builds an FM-index (a wavelet matrix over the BWT) over its different segments and streams
   them through it: backward search gives the longest factors that occur twice, and factors of WINDOW
   words or more are reported.
5. Reported spans meet by document, and the words they cover go.

Equal documents are one to all this: a document that has an equal one is removed whole if it holds
a window. Hashes have 64 bits, of which 48 go to the shards.

Defined results: null and empty texts have no words and the digest of nothing; documents below
WINDOW words lose none; rows that repeat are equal documents; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.bitfilter import bit_filter, passes
from tessera.llm.fmindex import FMIndex, repeated_spans
from tessera.llm.words import SPACED, Cut, cut_rows, fold_sums, scramble, spread, windows
from tessera.session import discard, materialize

WINDOW = 35
#: Words of an anchor.
ANCHOR = 8
#: Segments aimed at in a shard.
SHARD_SEGMENTS = 4096
#: Segments of one anchor up to which they go to one shard.
HOT = 1 << 16
#: Bytes of a word's hash that a shard gets.
WORD_BYTES = 6


def _sliding(values: np.ndarray, wide: int, least) -> np.ndarray:
    """least (or greatest) of each `wide` values that follow each other; empty if there are fewer."""
    width = 1
    while width < wide:
        step = min(width, wide - width)
        values = least(values[:-step], values[step:])
        width += step
    return values


class Segments:
    """The segments of some documents of a cut, those of at least a window among the chosen rows.

    row, anchor, start (in words of its row), at (in words of the cut) and many (windows) by segment.
    """

    def __init__(self, cut: Cut, chosen: np.ndarray, window: int, hot: np.ndarray | None = None):
        begin = cut.edges[:-1]
        held = np.where(chosen, np.maximum(0, cut.counts() - window + 1), 0)
        run = min(ANCHOR, window)
        self.cut, self.wide = cut, window - run + 1
        self.place = spread(begin, held)
        row = np.repeat(np.arange(cut.rows), held)
        self.runs = windows(cut.hashes, run)
        self.anchors = _sliding(self.runs, self.wide, np.minimum)[self.place] if len(self.place) else np.empty(0, np.uint64)
        if hot is not None and len(self.place) and (often := passes(hot, self.anchors)).any():
            self.anchors = np.where(often, windows(cut.hashes, window)[self.place], self.anchors)
        new = np.ones(len(self.place), bool)
        new[1:] = (self.anchors[1:] != self.anchors[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        self.row, self.anchor, self.at = row[first], self.anchors[first], self.place[first]
        self.start = self.at - begin[self.row]
        self.many = np.diff(np.r_[first, len(row)])

    def times(self) -> np.ndarray:
        """2 for segments whose anchor stands at more than one place that their windows select; else 1.

        Selected places that follow each other in a row with one value are those of one segment.
        """
        if not len(self.at):
            return np.empty(0, np.int64)
        padded = np.zeros(len(self.runs) + self.wide - 1, np.uint64)
        padded[self.place + self.wide - 1] = self.anchors
        padded = np.concatenate([padded, np.zeros(self.wide - 1, np.uint64)])
        chosen = np.flatnonzero(_sliding(padded, self.wide, np.maximum)[: len(self.runs)] == self.runs)
        row = np.searchsorted(self.cut.edges, chosen, "right")
        new = np.ones(len(chosen), bool)
        new[1:] = (self.runs[chosen][1:] != self.runs[chosen][:-1]) | (row[1:] != row[:-1])
        return np.minimum(2, np.diff(np.r_[np.flatnonzero(new), len(chosen)]))


def document_marks(cut: Cut) -> np.ndarray:
    """64 bits for each row that tell word sequences apart."""
    place = scramble(np.arange(1, len(cut.hashes) + 1, dtype=np.uint64) - np.repeat(cut.edges[:-1], cut.counts()).astype(np.uint64))
    return scramble(fold_sums(cut.hashes * (place | np.uint64(1)), cut.edges)).view(np.int64)


class Met(set):
    """What a task has met; emptied at `most`, as repeats do no harm."""

    def new(self, mark: int, most: int = 1_000_000) -> bool:
        if mark in self:
            return False
        if len(self) >= most:
            self.clear()
        self.add(mark)
        return True


def _lists(values: np.ndarray, many: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(many)], pa.int32()), pa.array(values))


def _profiles(docs: DataFrame, window: int) -> DataFrame:
    """Of each row doc_id, n, mark (null below a window), the digest of its words, and its anchors.

    An anchor stands twice for a segment that may repeat by itself; rows that a task has met have none.
    """

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = Met()
        for batch in batches:
            for cut in cut_rows(batch.column("_raw"), SPACED):
                n, marks = cut.counts(), document_marks(cut)
                fresh = np.fromiter((k >= window and met.new(m) for k, m in zip(n.tolist(), marks.tolist(), strict=True)), bool, cut.rows)
                found = Segments(cut, fresh, window)
                times = found.times()
                text, at = cut.joined()
                view, at = memoryview(text), at.tolist()
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").slice(cut.first, cut.rows),
                        "n": pa.array(n, pa.int64()),
                        "mark": pa.array(marks, mask=n < window),
                        "digest": pa.array([hashlib.sha256(view[a:b]).digest() for a, b in zip(at, at[1:], strict=False)], pa.binary()),
                        "anchors": _lists(np.repeat(found.anchor, times).view(np.int64), np.bincount(found.row, times, cut.rows).astype(np.int64)),
                    }
                )

    return docs.mapInArrow(profile, "doc_id long, n long, mark long, digest binary, anchors array<long>")


def _asked(batch: pa.RecordBatch, bits: np.ndarray) -> pa.Array:
    """The texts of the rows whose keys pass."""
    return batch.column("_raw").filter(pa.array(passes(bits, batch.column("_key").to_numpy())))


def _segments(docs: DataFrame, keys: np.ndarray, passing: np.ndarray, hot: np.ndarray | None, window: int) -> DataFrame:
    """The segments whose anchors pass: anchor, fp (of the words), mark, start, words and turn.

    The first of equal segments that a task meets has words; turn is 1 there, 2 for the next, else null.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, seen = Met(), {}
        for batch in batches:
            for cut in cut_rows(_asked(batch, keys), SPACED):
                marks = document_marks(cut)
                fresh = np.fromiter((k >= window and met.new(m) for k, m in zip(cut.counts().tolist(), marks.tolist(), strict=True)), bool, cut.rows)
                found = Segments(cut, fresh, window)
                keep = passes(passing, found.anchor)
                if not keep.any():
                    continue
                if hot is not None:
                    often = passes(hot, found.anchor)
                    if (keep & often).any():
                        # windows keep their anchor's right to pass
                        found = Segments(cut, fresh, window, hot)
                        keep = passes(passing, _sliding(found.runs, found.wide, np.minimum)[found.at])
                at, size = found.at[keep], found.many[keep] + window - 1
                ends = np.cumsum(size)
                fp = document_marks(_Rows(cut.hashes[spread(at, size)], np.r_[0, ends]))
                short = np.ascontiguousarray(cut.hashes.view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES]).tobytes()
                if len(seen) > 250_000:
                    seen.clear()
                turn, texts = [], []
                for f, a, k in zip(fp.tolist(), at.tolist(), size.tolist(), strict=True):
                    seen[f] = t = seen.get(f, 0) + 1
                    turn.append(t if t < 3 else None)
                    texts.append(short[a * WORD_BYTES : (a + k) * WORD_BYTES] if t == 1 else None)
                yield pa.record_batch(
                    {
                        "anchor": pa.array(found.anchor[keep].view(np.int64)),
                        "fp": pa.array(fp),
                        "mark": pa.array(marks[found.row[keep]]),
                        "start": pa.array(found.start[keep], pa.int32()),
                        "words": pa.array(texts, pa.binary()),
                        "turn": pa.array(turn, pa.int32()),
                    }
                )

    return docs.select("_key", "_raw").mapInArrow(emit, "anchor long, fp long, mark long, start int, words binary, turn int")


class _Rows:
    """Hashes of words in rows, as a cut has them."""

    def __init__(self, hashes: np.ndarray, edges: np.ndarray):
        self.hashes, self.edges = hashes, edges

    def counts(self) -> np.ndarray:
        return np.diff(self.edges)


def search_shard(texts: list[bytes], many: list[int], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Repeated spans of different segments (bytes of word hashes) that occur `many` times: segment, begin, end."""
    # what occurs more than once stands in the index twice, which is all that is asked
    twice = np.minimum(np.array(many), 2)
    raw = np.frombuffer(b"".join(x for x, n in zip(texts, twice.tolist(), strict=True) for _ in range(n)), np.uint8).reshape(-1, WORD_BYTES)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :WORD_BYTES] = raw
    different, ids = np.unique(wide.view(np.uint64).ravel(), return_inverse=True)
    sizes = np.repeat(np.array([len(x) // WORD_BYTES for x in texts]), twice)
    ends = np.cumsum(sizes + 1) - 1
    text = np.ones(int(sizes.sum()) + len(sizes), np.int64)  # 1 parts the segments
    inside = np.ones(len(text), bool)
    inside[ends] = False
    text[inside] = ids + 2
    index = FMIndex(text, len(different) + 2)
    asked = np.cumsum(twice) - twice
    begins = (ends - sizes)[asked]
    query, low, high = repeated_spans(index, text, begins, ends[asked], window)
    return query, low - begins[query], high - begins[query]


def _spans(segs: DataFrame, shards: int, window: int) -> DataFrame:
    """mark and spans (low, high) of documents with repeated windows."""

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        many = pdf.groupby("fp").size()
        own = pdf[pdf["words"].notna()].drop_duplicates("fp")
        fp = own["fp"].to_numpy()
        which, low, high = search_shard(own["words"].tolist(), many.loc[fp].tolist(), window)
        return pd.DataFrame({"of": fp[which], "low": low, "high": high})

    dealt = segs.where("turn IS NOT NULL").select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "fp", "words")
    found = dealt.groupBy("shard").applyInPandas(search, "of long, low int, high int")
    by_fp = found.groupBy("of").agg(F.collect_list(F.struct("low", "high")).alias("own"))
    placed = segs.select("fp", "mark", "start").join(by_fp, F.col("fp") == F.col("of"))
    spans = F.transform("own", lambda x: F.struct((F.col("start") + x["low"]).alias("low"), (F.col("start") + x["high"]).alias("high")))
    return placed.groupBy("mark").agg(F.flatten(F.collect_list(spans)).alias("spans"))


def _trimmed(docs: DataFrame, spans: DataFrame, window: int) -> DataFrame:
    """mark, removed and the digest of what is kept, of documents with spans (_key, mark, spans)."""
    keys, passing = bit_filter(spans, "_key"), bit_filter(spans, "mark")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = Met()
        for batch in batches:
            for cut in cut_rows(_asked(batch, keys), SPACED):
                marks = document_marks(cut)
                wanted = (passes(passing, marks) & (cut.counts() >= window)).tolist()
                text, at = cut.joined()
                found = [(m, text[a:b]) for m, w, a, b in zip(marks.tolist(), wanted, at[:-1].tolist(), at[1:].tolist(), strict=True) if w and met.new(m)]
                if found:
                    yield pa.record_batch({"mark": pa.array([m for m, _ in found], pa.int64()), "words": pa.array([t for _, t in found], pa.binary())})

    def trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, digests = [], []
            spans = batch.column("spans")
            low, high = (spans.flatten().field(x).to_numpy() for x in ("low", "high"))
            at = np.r_[0, np.cumsum(spans.value_lengths().to_numpy())].tolist()
            for text, a, b in zip(batch.column("words"), at, at[1:], strict=False):
                words = text.as_py().split(b" ")
                edge = np.bincount(low[a:b], minlength=len(words) + 1) - np.bincount(high[a:b], minlength=len(words) + 1)
                gone = np.cumsum(edge[:-1]) > 0
                removed.append(int(gone.sum()))
                digests.append(hashlib.sha256(b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()])).digest())
            yield pa.record_batch({"mark": batch.column("mark"), "removed": pa.array(removed, pa.int64()), "kept": pa.array(digests, pa.binary())})

    picked = docs.select("_key", "_raw").mapInArrow(pick, "mark long, words binary")
    joined = picked.join(spans.select("mark", "spans"), "mark").select("mark", "words", "spans")
    return joined.mapInArrow(trim, "mark long, removed long, kept binary").dropDuplicates(["mark"])


def _keys_with(profiles: DataFrame, passing: np.ndarray) -> DataFrame:
    """_key of the rows that have an anchor that passes."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchors = batch.column("anchors")
            row = np.repeat(np.arange(batch.num_rows), anchors.value_lengths().fill_null(0).to_numpy())
            rows = np.unique(row[passes(passing, anchors.flatten().to_numpy())])
            yield pa.record_batch({"_key": batch.column("_key").take(pa.array(rows))})

    return profiles.where("size(anchors) > 0").select(_key(), "anchors").mapInArrow(pick, "_key long")


def _key() -> Column:
    """What tells rows whose texts are asked for from the others; rows of one doc_id have one."""
    return F.xxhash64("doc_id").alias("_key")


def repeated_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of each row of docs."""
    raw = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("_raw"))
    profiles = materialize(_profiles(raw, window), "profiles")
    counted = profiles.select(F.explode("anchors").alias("anchor")).groupBy("anchor").agg(F.count("*").alias("times"))
    repeated = materialize(counted.where("times > 1"), "anchors")
    passing, often = bit_filter(repeated, "anchor"), repeated.where(F.col("times") > hot)
    keys = bit_filter(materialize(_keys_with(profiles, passing), "keys"), "_key")
    keyed = raw.select(_key(), "_raw")
    segs = materialize(_segments(keyed, keys, passing, bit_filter(often, "anchor") if often.head(1) else None, window), "segments")
    spans = materialize(_spans(segs, max(1, -(-segs.count() // SHARD_SEGMENTS)), window), "spans")
    discard(segs)
    copies = profiles.where("mark IS NOT NULL").groupBy("mark").agg(F.count("*").alias("copies"), F.min("n").alias("n"), F.min(_key()).alias("_key"))
    wanted = materialize(spans.join(copies.where("copies = 1").select("mark", "_key"), "mark"), "wanted")
    nothing = F.lit(hashlib.sha256(b"").digest())
    changed = _trimmed(keyed, wanted, window).unionByName(copies.where("copies > 1").select("mark", F.col("n").alias("removed"), nothing.alias("kept")))
    changed = changed.withColumnRenamed("mark", "of")
    return profiles.join(changed, F.col("mark") == F.col("of"), "left").select(
        "doc_id",
        F.col("n").alias("n_words"),
        F.coalesce("removed", F.lit(0)).alias("n_removed"),
        F.lower(F.hex(F.coalesce("kept", "digest"))).alias("kept_sha256"),
    )


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_words(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP6_SQL = r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS t FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM w WHERE len(w) >= 35)),
d AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY t) AS n FROM s) WHERE n > 1),
p AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM d),
g AS (SELECT r, list(p) AS gone FROM p GROUP BY r),
f AS (SELECT w.r, doc_id, w, gone FROM w LEFT JOIN g USING (r)),
k AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS kept FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM f)
      WHERE (r, i) NOT IN (SELECT r, p FROM p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM f LEFT JOIN k USING (r)
"""
