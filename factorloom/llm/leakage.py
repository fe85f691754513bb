"""Test items whose passages stand in a corpus, found by greedy string tiling.

Texts become hashes of their words, and running Karp-Rabin hashes of their windows of words, in DuckDB
and numpy. A window of a document that an item may hold, by a bit map of fixed size, is a seed; seeds
join the items' windows by hash. Of each document and item the seeds' diagonals give the matches, which
are marked from the longest down, never twice on a word of either side. Coverage of the item and its
longest tile decide.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorloom.functions.common import cut_lineage, group_count, task_count
from factorloom.llm.canonical import canonical_from, run_sql

# The bases of two running hashes modulo 2^64, odd so that nothing is lost.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
MAP_BITS = 26  # the bit map of the items' windows has 2^26 bits: 8 MB, however many items there are
CHUNK_BITS = 16  # it is put together in pieces of 2^16 bits
HOT_ROWS = 200_000  # seeds of one window in one task
RESULT = "doc_id long, item_id long, tiles int, matched_words int, longest_tile int, item_words int, coverage double"
OUT = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("tiles", pa.int32()), ("matched_words", pa.int32()), ("longest_tile", pa.int32()), ("item_words", pa.int32()), ("coverage", pa.float64())])
WINDOWS = pa.schema([("id", pa.int64()), ("words", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("at", pa.int32())])
WINDOWS_DDL = "id long, words int, h1 long, h2 long, at int"


# Fixed value: the longest runs of letters and digits of a canonical text, lower case, in DuckDB.
WORDS = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')"


def windows(words: np.ndarray, length: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts whose words' hashes lie one after the other: text, position and two hashes of each window of n words."""
    total = len(words) - n + 1
    if total < 1:
        empty = np.array([], np.int64)
        return empty, empty, empty, empty
    first = np.cumsum(length) - length
    text = np.repeat(np.arange(len(length)), length)[:total]
    at = np.arange(total) - first[text]
    own = at + n <= length[text]  # a window doesn't reach into the next text
    hashes = []
    with np.errstate(over="ignore"):
        for base in BASES:
            h = np.zeros(total, np.uint64)
            for k in range(n):
                h = h * np.uint64(base) + words[k : k + total]
            h ^= h >> np.uint64(29)
            hashes.append((h * np.uint64(BASES[0]))[own].view(np.int64))
    return text[own], at[own], *hashes


def _slot(h1: np.ndarray) -> np.ndarray:
    return (h1.view(np.uint64) >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def _windows_of(df: DataFrame, i: str, text: str, n: int, bits=None) -> DataFrame:
    """WINDOWS of the texts, or of them only those that the broadcast bit map knows."""
    sql = f"SELECT id, list_transform({WORDS}, lambda w: hash(w)) AS w FROM {canonical_from('batch', 'text')}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if bits is None else np.frombuffer(bits.value, np.uint8)
        for b in batches:
            if not b.num_rows:
                continue
            t = run_sql(b, sql)
            w = t["w"].combine_chunks()
            length = pc.fill_null(pc.list_value_length(w), 0).to_numpy().astype(np.int64)
            text_, at, h1, h2 = windows(pc.list_flatten(w).to_numpy().astype(np.uint64), length, n)
            if known is not None and len(h1):
                slot = _slot(h1)
                keep = (known[slot >> 3] >> (slot & 7)) & 1 == 1
                text_, at, h1, h2 = text_[keep], at[keep], h1[keep], h2[keep]
            ids = t["id"].to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(ids[text_]), pa.array(length[text_], pa.int32()), pa.array(h1), pa.array(h2), pa.array(at, pa.int32())], schema=WINDOWS)

    d = df.select(F.col(i).cast("long").alias("id"), F.col(text).cast("string").alias("text")).filter("id is not null and text is not null")
    return d.mapInArrow(run, WINDOWS_DDL)


def _bit_map(items: DataFrame) -> bytes:
    """The bit map of the items' windows: pieces that have a bit come to the driver, 2^MAP_BITS bits at most."""
    size = 1 << CHUNK_BITS
    slot = F.shiftrightunsigned("h1", 64 - MAP_BITS)

    def piece(key: tuple, t: pa.Table) -> pa.Table:
        bits = np.zeros(size, np.uint8)
        bits[t["slot"].to_numpy() % size] = 1
        return pa.table({"piece": [key[0].as_py()], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    slots = items.select(slot.alias("slot")).distinct().withColumn("piece", F.floor(F.col("slot") / size))
    out = np.zeros(1 << (MAP_BITS - 3), np.uint8)
    for r in slots.groupBy("piece").applyInArrow(piece, "piece long, bits binary").collect():
        out[r.piece * size // 8 : (r.piece + 1) * size // 8] = np.frombuffer(r.bits, np.uint8)
    return out.tobytes()


def matches(doc: dict[int, np.ndarray], item: dict[int, np.ndarray], n: int) -> list[tuple[int, int, int]]:
    """(length, position in doc, in item) of the maximal matches of at least n words.

    doc and item give the positions of each window's hash. The item's windows are gone through in
    order, and along each diagonal the matching windows are counted; what is kept is as long as the
    document, however often either text repeats itself.
    """
    order = sorted((int(p), h) for h, at in item.items() if h in doc for p in at)
    if not order:
        return []
    run = np.zeros(int(max(at.max() for h, at in doc.items() if h in item)) + 2, np.int64)  # windows matched up to each position
    none = np.array([], np.int64)
    last, last_at, out = none, -2, []

    def close(ended: np.ndarray, at: int) -> None:
        out.extend((int(k) + n - 1, int(p) - int(k) + 1, at - int(k) + 1) for p, k in zip(ended, run[ended]))

    for at, h in order:
        if at != last_at + 1:
            close(last, last_at)
            run[last] = 0
            last = none
        now = doc[h]
        length = np.where(now > 0, run[np.maximum(now - 1, 0)], 0) + 1
        close(np.setdiff1d(last, now - 1, assume_unique=True), last_at)
        run[last] = 0
        run[now] = length
        last, last_at = now, at
    close(last, last_at)
    return out


def tile(found: list[tuple[int, int, int]], n: int) -> list[int]:
    """Lengths of the tiles: the longest unmarked match again and again, at least n words long."""
    if not found:
        return []
    in_doc, in_item = (np.zeros(max(m[0] + m[k] for m in found), bool) for k in (1, 2))
    heap, tiles = [(-k, d, i) for k, d, i in found], []
    heapq.heapify(heap)
    while heap:
        k, d, i = heapq.heappop(heap)
        k = -k
        marked = in_doc[d : d + k] | in_item[i : i + k]
        if not marked.any():
            tiles.append(k)
            in_doc[d : d + k] = in_item[i : i + k] = True
            continue
        edge = np.flatnonzero(np.diff(np.r_[True, marked, True]))  # what is left of it goes back into the queue
        for a, b in zip(edge[::2], edge[1::2]):
            if b - a >= n:
                heapq.heappush(heap, (-int(b - a), d + int(a), i + int(a)))
    return tiles


def _tiled(t: pa.Table, n: int, least_run: int, least_coverage: float) -> pa.Table:
    """OUT of the seeds of one group of documents and items."""
    t = t.sort_by([("doc_id", "ascending"), ("item_id", "ascending")])
    doc, item = t["doc_id"].to_numpy(), t["item_id"].to_numpy()
    starts = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])]) if len(doc) else np.array([], int)
    rows = []
    if not len(doc):
        return OUT.empty_table()
    # so many windows of the item meet the document: too few can make neither a run nor, at n words each, the coverage
    met = np.add.reduceat(pc.list_value_length(t["item_at"]).to_numpy(), starts)
    maybe = (met >= least_run - n + 1) | (met * n >= least_coverage * t["item_words"].to_numpy()[starts])
    for a, b in zip(starts[maybe], np.append(starts[1:], len(doc))[maybe]):
        own = t.slice(a, b - a)
        in_doc, in_item = ({h: np.sort(np.asarray(p, np.int64)) for h, p in enumerate(own[c].to_pylist())} for c in ("doc_at", "item_at"))
        tiles = tile(matches(in_doc, in_item, n), n)
        words = own["item_words"][0].as_py()
        if tiles and (max(tiles) >= least_run or sum(tiles) >= least_coverage * words):
            rows.append((doc[a], item[a], len(tiles), sum(tiles), max(tiles), words, sum(tiles) / words))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), OUT)], schema=OUT) if rows else OUT.empty_table()


def leaked_items(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    shortest_tile: int = 12,
    least_run: int = 12,
    least_coverage: float = 1.0,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per document and item it holds: a run of least_run words, or tiles over least_coverage of it.

    Tiles are at least shortest_tile words long; with short ones and a coverage below 1, passages in
    another order come out too. Words are compared in canonical form (llm.canonical), case ignored, by
    128 bits of hashes. Null, empty and wordless texts hold nothing, and items of fewer than
    shortest_tile words can't be held; rows without id are left out. Repeated documents or items give
    repeated rows only if their ids differ; of one id with several texts the texts count together.

    The corpus is read once, whatever the number of items; only windows in the items' bit map (of fixed
    size, so that too many items make it let more through, never less) are shuffled. A window that stands
    in more than hot_rows documents is salted.
    """
    n = shortest_tile
    of_items = cut_lineage(_windows_of(items, item_id, item_text, n).groupBy("id", "h1", "h2").agg(F.max("words").alias("item_words"), F.collect_set("at").alias("item_at")))
    bits = docs.sparkSession.sparkContext.broadcast(_bit_map(of_items))
    seeds = _windows_of(docs, doc_id, text, n, bits)
    seeds = cut_lineage(seeds.groupBy("id", "h1", "h2").agg(F.collect_set("at").alias("doc_at")))  # the corpus is read once
    hot = seeds.groupBy("h1").count().filter(F.col("count") > hot_rows).select("h1", F.ceil(F.col("count") / hot_rows).alias("salts"))  # at most seeds / hot_rows rows
    salts = lambda x: x.join(F.broadcast(hot) if few else hot, "h1", "left").withColumn("salts", F.coalesce("salts", F.lit(1).cast("long")))
    few = hot.limit(100_001).count() <= 100_000
    left = salts(seeds).select(F.col("id").alias("doc_id"), "h1", "h2", "doc_at", F.pmod(F.xxhash64("id"), "salts").alias("s"))
    right = salts(of_items).select(F.col("id").alias("item_id"), "h1", "h2", "item_words", "item_at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("s"))
    met = left.join(right, ["h1", "h2", "s"])
    groups = group_count(seeds)
    met = met.select(F.pmod(F.xxhash64("doc_id", "item_id"), F.lit(groups)).alias("g"), "doc_id", "item_id", "item_words", "doc_at", "item_at")
    return met.repartition(task_count(groups, seeds), "g").groupBy("g").applyInArrow(lambda t: _tiled(t, n, least_run, least_coverage), RESULT)
