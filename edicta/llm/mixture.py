"""Mixing sources to target weights (problem 9).

Each source gets a share of the total size in tokens, as near its target as its documents and its cap of repeats allow; what a source
cannot give goes to the others in proportion to their targets. Documents are drawn by systematic sampling: the expected copies are
summed up document by document within the source, one random offset is added, and a document is emitted once per integer boundary its
interval crosses. The running sums are taken in two levels, over buckets of a source and within a bucket, so that no task holds a source.

Defined cases: documents without tokens, of unlisted sources or of null source are left out; sources without documents or with a cap
below one give nothing and are reported; targets need not sum to one; the same seed gives the same mixture; equal document ids are
separate rows; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_ROWS = 20_000


def offset(source: str, seed: int) -> float:
    """The source's random offset in [0, 1)."""
    return int.from_bytes(hashlib.sha256(f"{seed}/{source}".encode()).digest()[:6], "big") / 2**48


def allotted(sizes: dict[str, int], targets: dict[str, tuple[float, int]], total: float) -> dict[str, float]:
    """Tokens for each source: in proportion to the targets, none above its cap, the rest to the others."""
    open_ = {s for s, (share, cap) in targets.items() if share > 0 and cap > 0 and sizes.get(s, 0) > 0}
    out = dict.fromkeys(targets, 0.0)
    left = min(total, sum(sizes[s] * targets[s][1] for s in open_))
    while open_ and left > 0:
        weight = sum(targets[s][0] for s in open_)
        full = {s for s in open_ if left * targets[s][0] / weight >= sizes[s] * targets[s][1]}
        for s in full or open_:
            out[s] = sizes[s] * targets[s][1] if full else left * targets[s][0] / weight
        if not full:
            break
        left -= sum(out[s] for s in full)
        open_ -= full
    return out


def mixture(docs: DataFrame, targets: DataFrame, seed: int = 42, total: float | None = None) -> tuple[DataFrame, DataFrame]:
    """((doc_id, source, copy_no, n_tokens), plan). docs: (doc_id, source, n_tokens); targets: (source, target_share, max_repeats), a
    small table. total: tokens of the mixture, by default those of the listed documents."""
    spark = docs.sparkSession
    want = {r.source: (r.target_share or 0.0, r.max_repeats or 0) for r in targets.collect() if r.source is not None}
    names = spark.createDataFrame([(s,) for s in want], "source string")
    rows = docs.where("n_tokens > 0").join(F.broadcast(names), "source")
    found = {r.source: (r.docs, r.tokens) for r in rows.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("tokens")).collect()}
    sizes = {s: t for s, (_, t) in found.items()}
    give = allotted(sizes, want, total if total is not None else sum(sizes.values()))
    plan = [(s, *want[s], *found.get(s, (0, 0)), float(give[s]), give[s] / sizes[s] if sizes.get(s) else 0.0, offset(s, seed)) for s in sorted(want)]
    plan_df = spark.createDataFrame(plan, "source string, target_share double, max_repeats int, documents long, tokens long, wanted_tokens double, factor double, offset double")
    buckets = max(1, -(-max((n for n, _ in found.values()), default=1) // BUCKET_ROWS))
    # sums run over buckets by size, then documents by size: neighbours of the running sum are alike in size
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(buckets)))
    counts = rows.groupBy("source", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("source").orderBy("bucket")) - F.col("n")).drop("n")
    within = F.row_number().over(Window.partitionBy("source", "bucket").orderBy("n_tokens", F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id"))
    ranked = rows.withColumn("r", within).join(before, ["source", "bucket"]).join(F.broadcast(plan_df.select("source", "factor", "offset")), "source")
    rank = F.col("before") + F.col("r")
    copies = (F.floor(rank * F.col("factor") + F.col("offset")) - F.floor((rank - 1) * F.col("factor") + F.col("offset"))).cast("int")
    drawn = ranked.select("doc_id", "source", "n_tokens", copies.alias("copies")).where("copies > 0")
    return drawn.select("doc_id", "source", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy_no"), "n_tokens"), plan_df


def shares(docs: DataFrame, targets: DataFrame, seed: int = 42, total: float | None = None) -> DataFrame:
    """The report: per source its target, what it has, what was drawn, the share reached, most copies of a document."""
    drawn, plan = mixture(docs, targets, seed, total)
    per_doc = drawn.groupBy("source", "doc_id").agg(F.max("copy_no").alias("copies"), F.sum("n_tokens").alias("t"))
    got = per_doc.groupBy("source").agg(F.count(F.lit(1)).alias("drawn_documents"), F.sum("t").alias("drawn_tokens"), F.max("copies").alias("most_copies"))
    out = plan.join(got, "source", "left").select("source", "target_share", "max_repeats", "documents", "tokens", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("drawn_documents", "drawn_tokens", "most_copies")))
    return out.withColumn("share", F.round(F.col("drawn_tokens") / F.sum("drawn_tokens").over(Window.partitionBy()), 6))
