"""Mixing sources to target shares of tokens by pivotal dependent rounding.

Each record's expected number of copies follows from its source's target. The whole part is fixed;
the fractional parts are rounded in pairs: mass, counted in tokens, moves at random from one record
to the other until one of them is integral. That keeps every record's expectation and, but for one
record a source, the source's exact size. Chunks of records are rounded on their own, and what is left
of each, one record, goes up a tree of further roundings.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorloom.functions.common import cut_lineage, trimmed

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CHUNK, FAN = 20_000, 256
MOST_SOURCES = 10_000  # of a mixture
MOST_RANKS = 64 << 20  # bytes of a tokenizer's file
EPS = 1e-9


@cache
def tokenizer(ranks: bytes) -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def source_key(c: Column | str) -> Column:
    """Source names that compare equal: trimmed, lower case, spaces and hyphens as underscores."""
    return F.regexp_replace(F.lower(trimmed(c)), r"[\s\-]", "_")


def token_sizes(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", ranks: str = RANKS) -> DataFrame:
    """(doc_id, source, tokens): the size of each whole text in tokens; null and empty texts have none.

    ranks is the path of the tokenizer's file on the driver, which hands its content to the workers.
    """
    with open(ranks, "rb") as f:
        content = f.read(MOST_RANKS + 1)
    if len(content) > MOST_RANKS:
        raise ValueError(f"{ranks} is no file of ranks")
    content = docs.sparkSession.sparkContext.broadcast(content)
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), source_key(source).alias("source"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(content.value).encode_ordinary
        for b in batches:
            n = pa.array([len(encode(t)) for t in b.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), n], names=["doc_id", "source", "tokens"])

    return d.mapInArrow(run, "doc_id long, source string, tokens long")


def pivotal(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """p with all but at most one entry rounded to 0 or 1; sum(p * size) and each expectation stay.

    All open entries meet in pairs at once; of each pair at least one closes, so log2(n) rounds do.
    """
    p = p.astype(float).copy()
    is_open = lambda at: at[(p[at] > EPS) & (p[at] < 1 - EPS)]
    left = is_open(np.arange(len(p)))
    while len(left) > 1:
        half = len(left) // 2
        i, j = left[:half], left[half : 2 * half]
        w, u = size[i], size[j]
        up, down = np.minimum((1 - p[i]) * w, p[j] * u), np.minimum(p[i] * w, (1 - p[j]) * u)
        mass = np.where(rng.random(half) * (up + down) < down, up, -down)
        p[i] += mass / w
        p[j] -= mass / u
        left = np.concatenate([is_open(i), is_open(j), left[2 * half :]])
    whole = (p <= EPS) | (p >= 1 - EPS)
    p[whole] = np.round(p[whole])
    return p


ROW = "doc_id long, source string, tokens long, base long, p double, node long"


def _round_chunk(seed: int, last: bool):
    def run(key: tuple, t: pa.Table) -> pa.Table:
        source, node = (k.as_py() for k in key)
        t = t.take(pc.sort_indices(t, [("doc_id", "ascending"), ("tokens", "ascending"), ("p", "ascending")]))
        rng = np.random.default_rng([seed, node, *source.encode()])
        p = pivotal(t["p"].to_numpy(), t["tokens"].to_numpy().astype(float), rng)
        if last:  # of a source's last open record there is nothing to pair with
            rest = np.nonzero((p > 0) & (p < 1))[0]
            p[rest] = rng.random(len(rest)) < p[rest]
        return t.set_column(t.schema.get_field_index("p"), "p", pa.array(p))

    return run


def plan_shares(docs: DataFrame, targets: DataFrame, sizes: DataFrame, total_tokens: int | None = None) -> list[dict]:
    """Per source of targets: what there is, and the expected copies of each record (rate)."""
    rows = targets.limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources in a mixture")
    wanted = docs.sparkSession.createDataFrame([(r.source,) for r in rows], "source string")
    have = sizes.filter("tokens > 0").join(F.broadcast(wanted), "source").groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("records"))
    have = {r.source: r for r in have.collect()}  # a row per source of the targets
    live = [r for r in rows if r.source in have and r.target_share > 0 and r.max_repeats > 0]
    share = sum(r.target_share for r in live)
    most = min((r.max_repeats * have[r.source].tokens / (r.target_share / share) for r in live), default=0.0)
    if total_tokens is not None and total_tokens > most * (1 + 1e-9):
        raise ValueError(f"the sources give at most {int(most)} tokens at these shares")
    total = most if total_tokens is None else total_tokens
    plan = []
    for r in rows:
        h = have.get(r.source)
        rate = min(r.target_share / share * total / h.tokens, float(r.max_repeats)) if r in live else 0.0
        plan.append({"source": r.source, "target_share": float(r.target_share), "reachable_share": r.target_share / share if r in live else 0.0, "max_repeats": int(r.max_repeats), "records": h.records if h else 0, "tokens": h.tokens if h else 0, "rate": rate})
    return plan


PLAN = "source string, target_share double, reachable_share double, max_repeats long, records long, tokens long, rate double"


def mix_sources(docs: DataFrame, targets: DataFrame, *, total_tokens: int | None = None, seed: int = 7, ranks: str = RANKS, **columns: str) -> tuple[DataFrame, DataFrame]:
    """(copies, shares): the records used and how often, and the shares of tokens reached.

    targets has source, target_share and max_repeats; the mixture is as large as max_repeats allows
    at these shares, or has total_tokens. A source of targets without tokens can't have its share;
    the others keep their proportions (reachable_share). Records of other sources, of no source, or
    without a token are not used. copies: doc_id, source, tokens, copies (1 to max_repeats). Targets
    of one name are added up, the larger max_repeats holding. Empty tables give empty results. The
    outcome depends on seed and rows only, so a lost task comes out the same again.
    """
    spark = docs.sparkSession
    targets = targets.select(source_key("source").alias("source"), "target_share", "max_repeats").dropna()
    targets = targets.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    sizes = cut_lineage(token_sizes(docs, ranks=ranks, **columns))  # the texts are tokenised once
    plan = plan_shares(docs, targets, sizes, total_tokens)
    plan_df = spark.createDataFrame(plan, PLAN) if plan else spark.createDataFrame([], PLAN)
    use = sizes.filter("tokens > 0 and doc_id is not null").join(F.broadcast(plan_df.select("source", "rate", "records")), "source").filter("rate > 0")
    base = F.floor(F.col("rate") + EPS)
    p = F.greatest(F.col("rate") - base, F.lit(0.0))
    chunks = F.ceil(F.col("records") / CHUNK)
    rows = use.select("doc_id", "source", "tokens", base.cast("long").alias("base"), p.alias("p"), F.pmod(F.xxhash64("doc_id"), chunks).cast("long").alias("node"))
    width = max([-(-x["records"] // CHUNK) for x in plan if x["rate"]], default=1)
    done, left = [], rows
    while True:
        left = cut_lineage(left.groupBy("source", "node").applyInArrow(_round_chunk(seed, width == 1), ROW))
        if width == 1:
            break
        open_ = (F.col("p") > 0) & (F.col("p") < 1)
        done.append(left.filter(~open_))
        left = left.filter(open_).withColumn("node", F.floor(F.col("node") / FAN).cast("long"))
        width = -(-width // FAN)
        seed += 1
    out = left
    for x in done:
        out = out.unionByName(x)
    out = out.select("doc_id", "source", "tokens", (F.col("base") + F.round("p").cast("long")).alias("copies")).filter("copies > 0")
    used = out.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("used_tokens"), F.count("*").alias("used_records"), F.sum("copies").alias("used_copies"), F.max("copies").alias("most_copies"))
    shares = plan_df.join(used, "source", "left").na.fill(0, ["used_tokens", "used_records", "used_copies", "most_copies"])
    all_tokens = F.sum("used_tokens").over(Window.partitionBy(F.lit(1)))  # over the sources of the plan, 10000 at most
    shares = shares.withColumn("actual_share", F.coalesce(F.try_divide("used_tokens", all_tokens), F.lit(0.0))).drop("rate")
    return out, shares
