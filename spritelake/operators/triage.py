"""Rubric scores, buckets, anomalies, review queues and calibration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spritelake.functions.color import outline_score
from spritelake.functions.rules import first_match
from spritelake.operators import ordering

GATE, BORDER = 85, 70
HIGH_SHARE = 0.8
EXTREME_SIDES = 4.0


def technical(colors: Column) -> Column:
    return 25 - F.when(colors > 60, F.least(F.lit(15), F.floor((colors - 60) / 4))).when(colors > 30, 5).otherwise(0)


def construction(black_pixels: Column, banding_rows: Column, height: Column) -> Column:
    severity = F.round(F.least(F.lit(1.0), banding_rows / F.greatest(height, F.lit(1))), 3)
    outline = F.when(black_pixels > 0, ((F.lit(1.0) - outline_score(black_pixels)) * 10).cast("int")).otherwise(0)
    banding = F.when(banding_rows >= 2, (severity * 10).cast("int")).otherwise(0)
    return F.greatest(F.lit(0), 25 - outline - banding)


def readability(width: Column, height: Column, fill: Column) -> Column:
    small = F.when((width < 8) | (height < 8), 10).otherwise(0)
    sparse = F.when(fill < 0.1, 10).when(fill < 0.2, 5).otherwise(0)
    return F.greatest(F.lit(0), 20 - small - sparse)


def rubric_a(colors, black_pixels, banding_rows, width, height, fill, is_effect=None) -> Column:
    """A struct of the four parts, the total of at most 85 (95 for effects) and failure modes."""
    parts = [
        technical(colors).cast("int"), construction(black_pixels, banding_rows, height).cast("int"), readability(width, height, fill).cast("int"),
        (F.when(is_effect, 25).otherwise(15) if is_effect is not None else F.lit(15)).cast("int"),
    ]
    modes = F.filter(
        F.array(
            F.when(banding_rows >= 2, "banding_detected"), F.when(black_pixels > 0, "outline_issue"),
            F.when(fill < 0.1, "low_fill"), F.when(colors > 30, "palette_bloat"),
        ),
        lambda m: m.isNotNull(),
    )
    names = ("A1_technical", "A2_construction", "A3_readability", "A4_animation")
    total = (parts[0] + parts[1] + parts[2] + parts[3]).alias("total_score")
    return F.struct(*(p.alias(n) for p, n in zip(parts, names, strict=True)), total, modes.alias("failure_modes"))


def failure_modes(issues: Column) -> Column:
    """Failure modes by the wording of issue texts."""
    low = F.transform(issues, F.lower)

    def any_of(test) -> Column:
        return F.exists(low, test)

    return F.filter(
        F.array(
            F.when(any_of(lambda i: i.contains("pillow")), "pillow_shading_detected"),
            F.when(any_of(lambda i: i.contains("banding")), "banding_detected"),
            F.when(any_of(lambda i: i.contains("outline") | i.contains("black")), "outline_issue"),
            F.when(any_of(lambda i: i.contains("sparse")), "low_fill"),
            F.when(any_of(lambda i: i.contains("palette") & i.contains("color")), "palette_bloat"),
        ),
        lambda m: m.isNotNull(),
    )


def bucket(score: Column, is_tileset: Column) -> Column:
    return first_match([(is_tileset, F.lit("E_tileset")), (score >= GATE, F.lit("A_autopass")), (score >= BORDER, F.lit("B_borderline"))], F.lit("C_autoreject"))


def rank_thresholds(scores: DataFrame, score: str = "total_score") -> DataFrame:
    """One row (top5, bottom10): the scores at places n // 20 and min(n - 1, floor(0.9 n)) in
    falling order. Scores are few whole numbers: they are counted, and only the counts are put in
    order, whatever the number of sprites."""
    counts = scores.groupBy(score).agg(F.count("*").alias("c"))
    whole = Window.partitionBy()
    falling = Window.orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0)
    running = counts.withColumns({"upto": F.sum("c").over(falling), "n": F.sum("c").over(whole)})

    def element(k: Column) -> Column:
        return F.max(F.when(F.col("upto") > k, F.col(score)))

    n = F.col("n")
    return running.agg(element(F.floor(n / 20)).alias("top5"), element(F.least(n - 1, F.floor(n.cast("double") * 0.9))).alias("bottom10"))


def anomalies(scores: DataFrame, pack_col: str = "pack") -> DataFrame:
    """``scores`` with reasons (H1 good score with failures, H2 bad score in a good pack, H3
    extreme sides) and final_bucket. Tilesets are exempt but count in their packs' shares."""
    limits = rank_thresholds(scores.filter("NOT is_tileset"))
    shares = scores.groupBy(F.col(pack_col).alias("__pack")).agg(F.avg(F.when(F.col("bucket") == "A_autopass", 1.0).otherwise(0.0)).alias("a_share"))
    rows = scores.join(shares, F.col(pack_col).eqNullSafe(F.col("__pack"))).drop("__pack").crossJoin(F.broadcast(limits))  # limits are one row
    sides = F.greatest("width", "height") / F.greatest(F.least("width", "height"), F.lit(1))
    reasons = F.filter(
        F.array(
            F.when((F.col("total_score") >= F.col("top5")) & (F.size("failure_modes") > 0), "H1"),
            F.when((F.col("total_score") <= F.col("bottom10")) & (F.col("a_share") > HIGH_SHARE), "H2"),
            F.when(sides > EXTREME_SIDES, "H3"),
        ),
        lambda r: r.isNotNull(),
    )
    rows = rows.withColumn("reasons", F.when(F.col("is_tileset"), F.array().cast("array<string>")).otherwise(reasons))
    return rows.withColumn("final_bucket", F.when(F.size("reasons") > 0, "D_anomaly").otherwise(F.col("bucket"))).drop("top5", "bottom10", "a_share")


def review_queue(scores: DataFrame, decisions: DataFrame, bucket_name: str, key: str = "sprite_id") -> DataFrame:
    return scores.filter(F.col("bucket") == bucket_name).join(decisions.select(key), key, "left_anti")


def last_by_key(rows: DataFrame, key: str, order: Column) -> DataFrame:
    """One row a key: that of the highest ``order``; a max_by that combines before it shuffles."""
    whole = F.struct(*(c for c in rows.columns if c != key))
    return rows.groupBy(key).agg(F.max_by(whole, order).alias("r")).select(key, "r.*")


def calibration(decisions: DataFrame, scores: DataFrame, key: str = "sprite_id") -> DataFrame:
    """``decisions`` with total_score (of the scores, else as decided on, else -1), failure_modes
    and verdict: permissive, strict, flagged or agreed."""
    known = scores.select(key, F.col("total_score").alias("__known"), F.col("failure_modes").alias("__modes"))
    rows = decisions.join(known, key, "left")
    score = F.coalesce("__known", "score_at_decision", F.lit(-1))
    rows = rows.withColumns({"total_score": score, "failure_modes": F.coalesce("__modes", F.array().cast("array<string>"))}).drop("__known", "__modes")
    passed = F.col("total_score") >= GATE
    verdict = (
        F.when((F.col("decision") == "reject") & passed, "permissive").when((F.col("decision") == "accept") & ~passed, "strict")
        .when(F.col("decision") == "flag_recalibration", "flagged").otherwise("agreed")
    )
    return rows.withColumn("verdict", verdict)


def constant_rubric(letter: str) -> Column:
    """Rubrics B and C: fixed parts that never reach the gate, as a struct of total and passed."""
    total = {"B": 80, "C": 75}[letter]
    return F.struct(F.lit(total).alias("total_score"), F.lit(False).alias("passed"))


HUMAN_GATE = 95


def human_gate(automated: Column, originality: Column, soul: Column) -> Column:
    """A struct (shown, combined, passed): only a full automated score is shown to a person, who adds
    up to 10 points for originality and up to 5 for soul; together they must reach 95."""
    shown = F.coalesce(automated == 85, F.lit(False))
    added = F.greatest(F.lit(0), F.least(F.lit(10), originality)) + F.greatest(F.lit(0), F.least(F.lit(5), soul))
    combined = F.when(shown, automated + F.coalesce(added, F.lit(0)))
    return F.struct(shown.alias("shown"), combined.alias("combined"), F.coalesce(combined >= HUMAN_GATE, F.lit(False)).alias("passed"))


def suggestions(calibrated: DataFrame, over: int = 10) -> DataFrame:
    """(verdict, n, mode, action): for permissive and strict decisions, where there are more than
    ``over``, the failure mode that is named most and what to do about its weight."""
    modes = disagreement_modes(calibrated).groupBy("verdict").agg(F.min(F.struct((-F.col("n")).alias("k"), "mode")).alias("top"))
    n = calibrated.filter(F.col("verdict").isin("permissive", "strict")).groupBy("verdict").agg(F.count("*").alias("n"))
    action = F.when(F.col("verdict") == "permissive", "tighten").otherwise("relax")
    return n.filter(F.col("n") > over).join(modes, "verdict").select("verdict", "n", F.col("top.mode").alias("mode"), action.alias("action"))


def batches(rows: DataFrame, keys: tuple[str, ...], order: str, passed: Column, size: int = 100, share: float = 0.99) -> DataFrame:
    """(keys, batch, n, passed, ok): of each batch of ``size`` completions in order, how many pass,
    and whether that is enough."""
    placed = ordering.running(rows.select(*keys, order, passed.alias("__passed")), [order], {}, keys)
    out = placed.groupBy(*keys, F.floor((F.col("place") - 1) / size).alias("batch"))
    out = out.agg(F.count("*").alias("n"), F.sum(F.col("__passed").cast("int")).alias("passed"))
    return out.withColumn("ok", F.col("passed") >= F.col("n") * share)


def failure_clusters(rows: DataFrame, key: str, cluster: list[str], order: str, passed: Column, least: float = 0.90) -> DataFrame:
    """(cluster, n, least_rate): failures at which the running pass rate of their group is below
    ``least``, counted by cluster."""
    plain = rows.select(*dict.fromkeys([key, *cluster, order]), passed.alias("__passed"))
    at = ordering.running(plain, [order], {"good": F.col("__passed").cast("int")}, (key,))
    rate = F.col("good") / F.col("place")
    return at.filter(~F.col("__passed") & (rate < least)).groupBy(*cluster).agg(F.count("*").alias("n"), F.min(rate).alias("least_rate"))


def disagreement_modes(calibrated: DataFrame) -> DataFrame:
    """(verdict, mode, n) of permissive and strict decisions; ``no_flag`` where no mode is named."""
    rows = calibrated.filter(F.col("verdict").isin("permissive", "strict"))
    modes = F.when(F.size("failure_modes") == 0, F.array(F.lit("no_flag"))).otherwise(F.col("failure_modes"))
    return rows.select("verdict", F.explode(modes).alias("mode")).groupBy("verdict", "mode").agg(F.count("*").alias("n"))
