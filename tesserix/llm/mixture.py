"""Mixing sources to target weights by weighted fair queueing.

Method: every document copy gets a virtual finish time, the tokens its source
has given up to and with it divided by the source's target weight; the copies
are cut off at the virtual time at which the budget is spent and range-sorted by
it.  Documents of a source stand in a shuffled order (a seeded hash), a source
starts again from the front when it runs out, at most `max_repeats` times in all.

Since a round through a source is whole but for its last, each source has a
number of whole rounds and a rest; only the rest needs a cut, and copies are
written out only where they are drawn.  A document too long for what is left of
the rest is passed over and the queue goes on behind it, until the gap is below
GAP of the source's quota or nothing left fits.

Sizes are tokens of a public tokenizer, counted once per document and kept as a
narrow table in the shared folder.  Running totals are taken in two steps, per
(source, slice of the hash order) and inside a slice, so that no source is held
in one task.  Of each target one row comes to the driver.

The budget: EXACT (default) is the largest total at which every source with
documents keeps its share against the others; with a number of tokens, sources
that come to their cap give that and the others share the rest by their weights.

Defined results: documents with a null source or text, and sources without a
target, take no part; a target without documents gets share 0, so that the
others' shares are theirs of what the present ones sum to; a text without
tokens is never drawn; targets repeated for one source count with the largest
share; max_repeats null or below 1 counts as 1.
"""

from __future__ import annotations

import base64
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesserix.session import write_once

SLICES = 256
EXACT = -1
#: Share of a source's quota that may stay open, and the most passes behind documents too long for it.
GAP, PASSES = 0.005, 12
#: Vocabulary file of the tokenizer package; a full path may be given instead.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


@lru_cache(maxsize=2)
def _encoding(vocabulary: str):
    import public_tokenizers
    import tiktoken

    path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Tokens of a text; special tokens' strings are ordinary text; null for null."""

    @F.arrow_udf(T.LongType())
    def count(texts: pa.Array) -> pa.Array:
        encode = _encoding(vocabulary).encode_ordinary
        return pa.array([None if t is None else len(encode(t)) for t in texts.to_pylist()], pa.int64())

    return count(text)


def source_name(source: Column) -> Column:
    """Trimmed, in lower case, with _ for blanks and hyphens."""
    return F.regexp_replace(F.lower(F.regexp_replace(source, r"^\s+|\s+$", "")), r"[\s\-]+", "_")


def _targets(targets: DataFrame) -> DataFrame:
    return (
        targets.select(source_name(F.col("source")).alias("source"), F.col("target_share").cast("double").alias("share"), F.greatest(F.coalesce(F.col("max_repeats"), F.lit(1)), F.lit(1)).alias("repeats"))
        .where("source is not null and share > 0")
        .groupBy("source")
        .agg(F.max(F.struct("share", "repeats")).alias("t"))
        .select("source", "t.share", "t.repeats")
    )


def quotas(sources: list[dict], budget: int) -> dict[str, float]:
    """Tokens of each source (source, total, share, repeats): its weight's part of the budget, or its cap."""
    cap = {r["source"]: float(r["repeats"] * r["total"]) for r in sources}
    share = {r["source"]: r["share"] for r in sources}
    if budget == EXACT:
        time = min((cap[s] / share[s] for s in cap), default=0.0)
        return {s: share[s] * time for s in cap}
    out: dict[str, float] = {}
    left, rest = float(max(budget, 0)), sorted(cap, key=lambda s: cap[s] / share[s])
    while rest:
        time = left / sum(share[s] for s in rest)
        s = rest[0]
        if cap[s] > share[s] * time:
            return out | {x: share[x] * time for x in rest}
        out[s] = cap[s]
        left -= cap[s]
        rest.pop(0)
    return out


class Mixture:
    """A drawn mixture: `documents()` with their copies, `sequence()` of all copies, `shares()` as the report."""

    def __init__(self, docs: DataFrame, targets: DataFrame, budget_tokens: int | None = None, seed: int = 7, vocabulary: str = VOCABULARY):
        self.targets = _targets(targets)
        sized = docs.select("doc_id", source_name(F.col("source")).alias("source"), token_count(F.col("text"), vocabulary).alias("tokens"))
        mark = F.xxhash64(F.col("doc_id"), F.lit(seed))
        piece = F.shiftrightunsigned("mark", 64 - 8).cast("int")  # SLICES = 256 equal slices of the shuffled order
        self.sized = write_once(sized.where("source is not null and tokens > 0").withColumn("mark", mark).withColumn("slice", piece), "token-counts")
        self.totals = self.sized.groupBy("source").agg(F.sum("tokens").alias("total")).join(self.targets, "source")
        held = [r.asDict() for r in self.totals.select("source", "total", "share", "repeats").collect()]  # one row a target
        quota = quotas(held, EXACT if budget_tokens is None else budget_tokens)
        self.budget = int(sum(quota.values())) if budget_tokens in (None, EXACT) else budget_tokens
        self.drawn = self._draw(held, quota)

    def _draw(self, held: list[dict], quota: dict[str, float]) -> DataFrame:
        """(doc_id, source, tokens, total, share, rounds, start, finish_rest): whole rounds of the source, place in them, and the finish of the copy in the rest, if drawn."""
        spark = self.sized.sparkSession
        plan, left, wanted = [], {}, {}
        for r in held:
            q = quota[r["source"]]
            rounds = min(int((q + 1e-6) // r["total"]), r["repeats"])
            rest = q - rounds * r["total"] if rounds < r["repeats"] else 0.0
            plan.append((r["source"], int(r["total"]), float(r["share"]), rounds))
            left[r["source"]], wanted[r["source"]] = rest, q
        known = F.broadcast(spark.createDataFrame(plan, "source string, total long, share double, rounds int"))
        base = write_once(_running(self.sized).join(known, "source").withColumnRenamed("run", "end"), "queue")
        parts: list[DataFrame] = []
        given = {s: 0 for s in left}
        behind = base
        for turn in range(PASSES):
            # The queue of the rest: what still fits, in the shuffled order, up to what is left.
            open_ = [(s, float(left[s]), float(given[s])) for s in left if left[s] >= 1 and (turn == 0 or left[s] > GAP * wanted[s])]
            if not open_:
                break
            room = F.broadcast(spark.createDataFrame(open_, "source string, room double, given double"))
            queue = behind.drop("run", "room", "given").join(room, "source")
            queue = write_once(_running(queue.where("tokens <= room")), "rest") if turn else queue.withColumn("run", F.col("end"))
            taken = queue.where("run <= room")
            gave = {r["source"]: r["n"] for r in taken.groupBy("source").agg(F.sum("tokens").alias("n")).collect()}
            if turn and not gave:
                break
            parts.append(taken.select("source", "end", ((F.col("rounds") * F.col("total") + F.col("given") + F.col("run")) / F.col("share")).alias("finish_rest")))
            for s, n in gave.items():
                left[s] -= n
                given[s] += n
            behind = queue.where("run > room")
        drawn = base.select("doc_id", "source", "tokens", "total", "share", "rounds", "end")
        if not parts:
            return drawn.withColumn("finish_rest", F.lit(None).cast("double")).where("rounds > 0")
        return drawn.join(reduce(DataFrame.unionByName, parts), ["source", "end"], "left").where("rounds > 0 or finish_rest is not null")

    def documents(self) -> DataFrame:
        """(doc_id, source, copies, tokens of one copy, finish of the first copy) in order of the first finish."""
        copies = F.col("rounds") + F.col("finish_rest").isNotNull().cast("int")
        first = F.when(F.col("rounds") > 0, F.col("end") / F.col("share")).otherwise(F.col("finish_rest"))
        return self.drawn.select("doc_id", "source", copies.alias("copies"), "tokens", first.alias("first_finish")).orderBy("first_finish", "source", "doc_id")

    def sequence(self) -> DataFrame:
        """The mixture itself: (doc_id, source, epoch, tokens, finish) of every copy, range-sorted by finish, sources interleaved."""
        whole = F.transform(F.sequence(F.lit(1), F.col("rounds")), lambda e: F.struct((e - 1).alias("epoch"), (((e - 1) * F.col("total") + F.col("end")) / F.col("share")).alias("finish")))
        whole = F.when(F.col("rounds") > 0, whole).otherwise(F.array().cast("array<struct<epoch:int,finish:double>>"))
        rest = F.array(F.when(F.col("finish_rest").isNotNull(), F.struct(F.col("rounds").alias("epoch"), F.col("finish_rest").alias("finish"))))
        copies = self.drawn.select("doc_id", "source", "tokens", F.explode(F.array_compact(F.concat(whole, rest))).alias("c"))
        return copies.select("doc_id", "source", "c.epoch", "tokens", "c.finish").orderBy("finish", "source", "doc_id", "epoch")

    def shares(self) -> DataFrame:
        """Per target source: what it holds, what it gave, the share reached, that share against the target among the sources present, and how often it was used over."""
        held = self.totals.select("source", F.col("total").alias("held_tokens"))
        copies = F.col("rounds") + F.col("finish_rest").isNotNull().cast("int")
        given = self.drawn.groupBy("source").agg(F.sum(F.col("tokens") * copies).alias("given_tokens"), F.sum(copies).alias("copies"))
        out = self.targets.join(held, "source", "left").join(given, "source", "left").na.fill(0, ["held_tokens", "given_tokens", "copies"])
        everything = Window.partitionBy()
        total, present = F.sum("given_tokens").over(everything), F.sum(F.when(F.col("held_tokens") > 0, F.col("share"))).over(everything)
        reached = F.when(total > 0, F.col("given_tokens") / total).otherwise(F.lit(0.0))
        return out.select(
            "source",
            F.col("share").alias("target_share"),
            F.col("repeats").alias("max_repeats"),
            "held_tokens",
            "given_tokens",
            "copies",
            reached.alias("reached_share"),
            F.when(F.col("held_tokens") > 0, reached * present / F.col("share")).alias("of_target"),
            F.when(F.col("held_tokens") > 0, F.col("given_tokens") / F.col("held_tokens")).otherwise(F.lit(0.0)).alias("times_used"),
        )


def _running(rows: DataFrame) -> DataFrame:
    """Adds `run`, the tokens of the source up to and with each row in the shuffled order: slice totals first, then inside each slice."""
    slices = rows.groupBy("source", "slice").agg(F.sum("tokens").alias("held"))
    before = F.coalesce(F.sum("held").over(Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = Window.partitionBy("source", "slice").orderBy("mark", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("in_slice", F.sum("tokens").over(inside)).join(slices.select("source", "slice", before.alias("before")), ["source", "slice"]).withColumn("run", F.col("before") + F.col("in_slice")).drop("before", "in_slice")


def mix(docs: DataFrame, targets: DataFrame, **how) -> Mixture:
    return Mixture(docs, targets, **how)
