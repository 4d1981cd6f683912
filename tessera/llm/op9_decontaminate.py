"""Benchmark decontamination by a stored positional inverted index that is dealt by document.

1. The documents are cut into segments, and each segment's postings (the places of every term, sorted)
   are written as one row of the index. Terms are 64-bit hashes of words.
2. The index says how often each benchmark term stands in the whole corpus, so that the rarest term of
   every window is known.
3. In each segment a window's candidates are the postings of its rarest term. They are moved to the
   places where its other terms would stand and intersected with those terms' postings, from the rarer to
   the more frequent. What is left are exact occurrences. With `slop`, every term may lie up to that many
   places off, inside the document, from where one alignment of the window would put it, which gives
   proximity matches beside the exact ones.

Benchmark items come to the driver and the tasks in blocks of at most BLOCK_WORDS words, one at a time,
each a pass over the index; matches of several blocks meet by row.

Defined results: null or empty documents have no words and no hits; null or empty items have no
windows; a null item_id is no item that could be reported; items of equal id are one item; rows of
documents that repeat are judged one by one; without items nothing is hit; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.words import LETTERED, cut_rows, lettered_words, spread
from tessera.session import discard, materialize

WIDTH, MIN_ITEMS = 8, 2
#: Words of benchmark items that the driver and a task hold at once.
BLOCK_WORDS = 500_000
#: Bytes of texts in a segment; a longer text is a segment of its own.
SEGMENT = 1 << 18

INDEX = "segment long, doc_ids array<long>, marks array<long>, sizes array<long>, terms binary, ends binary, places binary"


def postings(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different terms in order, where each one's places end, and the places, in order by term."""
    n = len(hashes)
    low = np.uint64((1 << n.bit_length()) - 1)
    packed = (hashes & ~low) | np.arange(n, dtype=np.uint64)
    packed.sort()
    places = (packed & low).astype(np.int32)
    terms = hashes[places]
    if (terms[1:] < terms[:-1]).any():  # terms that differ in the bits that places have taken
        places = np.argsort(hashes, kind="stable").astype(np.int32)
        terms = hashes[places]
    first = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]]) if n else np.empty(0, np.int64)
    return terms[first], np.r_[first[1:], n][: len(first)].astype(np.int32), places


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", segment: int = SEGMENT) -> DataFrame:
    """The index of docs, written into the shared folder. mark: xxhash64 of the text."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for cut in cut_rows(batch.column("_raw"), LETTERED, segment):
                own = batch.slice(cut.first, cut.rows)
                terms, ends, places = postings(cut.hashes)
                yield pa.record_batch(
                    {
                        "segment": pa.array([number], pa.int64()),
                        "doc_ids": _one_list(own.column("doc_id")),
                        "marks": _one_list(own.column("_mark")),
                        "sizes": _one_list(pa.array(cut.counts(), pa.int64())),
                        "terms": pa.array([terms.tobytes()], pa.binary()),
                        "ends": pa.array([ends.tobytes()], pa.binary()),
                        "places": pa.array([places.tobytes()], pa.binary()),
                    }
                )
                number += 1

    own = F.col(f"`{text}`")
    raw = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(own).alias("_mark"), own.cast("binary").alias("_raw"))
    return materialize(raw.mapInArrow(build, INDEX), "index")


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


class Block:
    """Windows of some benchmark items: words (places in vocabulary) of windows by width, and their items."""

    def __init__(self, items: list[tuple[str, bytes]], width: int):
        (cut,) = cut_rows(pa.array([raw for _, raw in items], pa.binary()), LETTERED, 1 << 62) if items else (None,)
        self.vocabulary, words = np.unique(cut.hashes, return_inverse=True) if cut else (np.empty(0, np.uint64), None)
        found: dict[int, dict[bytes, set]] = {}
        for i, (name, _) in enumerate(items):
            own = words[cut.edges[i] : cut.edges[i + 1]].astype(np.int32)
            step = min(width, len(own))
            for k in range(len(own) - step + 1 if step else 0):
                found.setdefault(step, {}).setdefault(own[k : k + step].tobytes(), set()).add(name)
        self.groups = [(step, np.frombuffer(b"".join(own), np.int32).reshape(-1, step), [sorted(x) for x in own.values()]) for step, own in sorted(found.items())]
        self.order: list[np.ndarray] = []

    def rank(self, counts: np.ndarray) -> None:
        """counts: of each word of the vocabulary in the corpus. Each window's places from the rarest word on."""
        self.order = [np.argsort(counts[words], axis=1, kind="stable") for _, words, _ in self.groups]

    def search(self, terms: np.ndarray, ends: np.ndarray, places: np.ndarray, edges: np.ndarray, slop: int = 0) -> Iterator[tuple]:
        """Matches in a segment: their first word, the end behind their last, whether exact, their window, and the items by window."""
        at = np.searchsorted(terms, self.vocabulary)
        here = at < len(terms)
        here[here] = terms[at[here]] == self.vocabulary[here]
        keyed = None
        for (step, words, names), order in zip(self.groups, self.order, strict=True):
            window = np.flatnonzero(here[words].all(1))
            if not len(window):
                continue
            if keyed is None:
                n, begins = len(places), np.r_[0, ends[:-1]].astype(np.int64)
                keyed = np.repeat(np.arange(len(terms)), np.diff(np.r_[0, ends])) * n + places
            first = order[window, 0]
            pivot = at[words[window, first]]
            many = ends[pivot] - begins[pivot]
            window, first = np.repeat(window, many), np.repeat(first, many)
            place = places[spread(begins[pivot], many)].astype(np.int64)
            # an alignment may put the rarest term itself some places off
            shift = np.tile(np.arange(-slop, slop + 1), len(place))
            window, first, place = (np.repeat(x, 2 * slop + 1) for x in (window, first, place))
            row = np.searchsorted(edges, place, "right")
            low, high = edges[row - 1], edges[row]
            begin, end, exact = place.copy(), place + 1, shift == 0
            for k in range(1, step):
                other = order[window, k]
                term = at[words[window, other]] * n
                nominal = place + shift + other - first
                found = self._at(keyed, term + nominal, (nominal >= low) & (nominal < high))
                where, hit = nominal, found
                if slop:
                    # the first place of the term that is near enough and in the document
                    near = np.searchsorted(keyed, term + np.maximum(nominal - slop, low))
                    value = keyed[np.minimum(near, len(keyed) - 1)]
                    close = (near < len(keyed)) & (value <= term + np.minimum(nominal + slop, high - 1)) & (value >= term + low)
                    where, hit = np.where(found, nominal, value - term), found | close
                begin, end = np.minimum(begin, where)[hit], np.maximum(end, where + 1)[hit]
                exact = (exact & found)[hit]
                window, first, place, shift, low, high = (x[hit] for x in (window, first, place, shift, low, high))
                if not len(window):
                    break
            if len(window):
                yield begin, end, exact, window, names

    @staticmethod
    def _at(keyed: np.ndarray, key: np.ndarray, inside: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(keyed, key), len(keyed) - 1)
        return inside & (keyed[at] == key)


def _block_items(benchmark: DataFrame, most: int) -> Iterator[list[tuple[str, bytes]]]:
    """Items in blocks of at most `most` words; an item that is longer makes a block."""
    size = F.length(F.col("text").cast("binary"))
    items = benchmark.where("text IS NOT NULL AND item_id IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text"), size.alias("size"))
    block, n = [], 0
    for row in items.orderBy("item_id").toLocalIterator():
        words = len(lettered_words(bytes(row["text"])))
        if block and n + words > most:
            yield block
            block, n = [], 0
        block.append((row["item_id"], bytes(row["text"])))
        n += words
    yield block


def _unpacked(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    kinds = {"terms": np.uint64, "ends": np.int32, "places": np.int32}
    for batch in batches:
        for row in zip(*[batch.column(c) for c in names], strict=True):
            yield tuple(np.frombuffer(x.as_buffer(), kinds[c]) if c in kinds else x for c, x in zip(names, row, strict=True))


def term_counts(index: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """How often each of these terms stands in the whole corpus; each task's counts are added up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for terms, ends in _unpacked(batches, "terms", "ends"):
            if len(terms):
                at = np.minimum(np.searchsorted(terms, vocabulary), len(terms) - 1)
                total += np.where(terms[at] == vocabulary, np.diff(np.r_[0, ends])[at], 0)
        at = np.flatnonzero(total)
        yield pa.record_batch({"term": pa.array(at, pa.int64()), "n": pa.array(total[at], pa.int64())})

    out = np.zeros(len(vocabulary), np.int64)
    for row in index.select("terms", "ends").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[row["term"]] = row["n"]
    return out


def find_phrases(index: DataFrame, block: Block, slop: int = 0) -> DataFrame:
    """Matches of a block: segment, row (of the segment), item, begin and end (words of the document), exact."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment, sizes, terms, ends, places in _unpacked(batches, "segment", "sizes", "terms", "ends", "places"):
            edges = np.r_[0, np.cumsum(np.array(sizes.as_py(), np.int64))]
            for begin, end, exact, window, names in block.search(terms, ends, places, edges, slop):
                row = np.searchsorted(edges, begin, "right") - 1
                many = np.array([len(names[w]) for w in window.tolist()])
                at = np.repeat(np.arange(len(window)), many)
                yield pa.record_batch(
                    {
                        "segment": pa.array(np.full(len(at), segment.as_py())),
                        "row": pa.array(row[at], pa.int64()),
                        "item": pa.array([x for w in window.tolist() for x in names[w]], pa.string()),
                        "begin": pa.array((begin - edges[row])[at], pa.int64()),
                        "end": pa.array((end - edges[row])[at], pa.int64()),
                        "exact": pa.array(exact[at]),
                    }
                )

    wanted = index.select("segment", "sizes", "terms", "ends", "places")
    return wanted.mapInArrow(find, "segment long, row long, item string, begin long, end long, exact boolean")


def matches(index: DataFrame, benchmark: DataFrame, width: int = WIDTH, slop: int = 0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """segment, row, item, begin, end, exact of all matches; a block of items at a time passes over the index."""
    parts = []
    for items in _block_items(benchmark, block_words):
        block = Block(items, width)
        block.rank(term_counts(index, block.vocabulary))
        parts.append(materialize(find_phrases(index, block, slop), "matches"))
    return reduce(DataFrame.unionByName, parts)


def _covered(spans: Column) -> Column:
    """How many words lie in some of these spans (sorted structs of begin and end)."""
    start = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("n"))

    def step(so_far: Column, span: Column) -> Column:
        upto = F.greatest(so_far["upto"], span["end"])
        return F.struct(upto.alias("upto"), (so_far["n"] + upto - F.greatest(so_far["upto"], F.least(span["begin"], upto))).alias("n"))

    return F.aggregate(spans, start, step, lambda x: x["n"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, slop: int = 0, min_items: int = MIN_ITEMS, block_words: int = BLOCK_WORDS, segment: int = SEGMENT) -> DataFrame:
    """doc_id, mark (xxhash64 of the text), n_words, n_hit, n_items, items (ids as strings, sorted), n_near and contaminated.

    n_hit: words of exact matches; n_items and items: of exact matches; n_near: items with proximity matches only.
    """
    index = build_index(docs, doc_id, text, segment)
    found = matches(index, benchmark, width, slop, block_words)
    exact = F.col("exact")
    by_row = found.groupBy(F.col("segment").alias("of"), F.col("row").alias("of_row")).agg(
        F.array_sort(F.collect_set(F.when(exact, F.struct("begin", "end")))).alias("spans"),
        F.array_sort(F.collect_set(F.when(exact, F.col("item")))).alias("items"),
        F.array_sort(F.collect_set("item")).alias("any"),
    )
    lists = materialize(index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "marks", "sizes")).alias("row", "own")), "rows")
    discard(index)
    joined = lists.join(by_row, (F.col("segment") == F.col("of")) & (F.col("row") == F.col("of_row")), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        F.col("own.doc_ids").alias("doc_id"),
        F.col("own.marks").alias("mark"),
        F.col("own.sizes").alias("n_words"),
        F.coalesce(_covered(F.col("spans")), F.lit(0)).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        items.alias("items"),
        (F.coalesce(F.size("any"), F.lit(0)) - F.size(items)).cast("long").alias("n_near"),
        (F.size(items) >= min_items).alias("contaminated"),
    )


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


OP9_SQL = r"""
WITH dw AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
bs AS (SELECT item, w, least(8, len(w)) AS k FROM bw WHERE len(w) > 0),
win AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS t FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM bs)),
ks AS (SELECT DISTINCT k FROM win),
ds AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS t FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, ks WHERE len(w) >= k)),
hits AS (SELECT ds.r, ds.i, ds.k, win.item FROM ds JOIN win ON ds.k = win.k AND ds.t = win.t),
places AS (SELECT r, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(DISTINCT item)::BIGINT AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated
FROM dw LEFT JOIN places USING (r) LEFT JOIN items USING (r)
"""
