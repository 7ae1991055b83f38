"""Acceptance of shots: view, confidence, close-ups, homogeneity, framing, delivery plausibility."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vector

# The views, the wanted one first, and why each other is rejected.
VIEWS = ("center_field_good", "side_fullbody_acceptable", "closeup_bad", "batter_bad", "field_bad", "graphic_bad", "other_bad")
REASONS = {"side_fullbody_acceptable": "non_center_field_side_view_reserved", "closeup_bad": "closeup", "batter_bad": "wrong_view_batter", "field_bad": "wrong_view_field", "graphic_bad": "graphic_transition", "other_bad": "other_rejected"}


def reject_reason(view: Column, confidence: Column, contaminated: Column, closeup: Column, wanted: str = VIEWS[0], least: float = 0.5) -> Column:
    """Why a shot is not accepted, null if it is: view, confidence, transition, close-up, in this order. An unknown view is an error."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(view != wanted, F.coalesce(F.create_map(*[F.lit(x) for kv in REASONS.items() for x in kv])[view], F.raise_error(F.concat(F.lit("unknown view: "), view)))).when(confidence < least, "low_view_confidence")
        .when(yes(contaminated), "transition_contaminated").when(yes(closeup), "homogeneous_closeup")
    )


def closeup_veto(margin: Column, second: Column, edge_density: Column, field: str = "field_bad") -> Column:
    """A clear margin stays; a small one goes unless the runner-up is the field; between them texture decides; unknown stays."""
    rest = F.coalesce(edge_density < 0.10, F.lit(False))
    return F.when(margin.isNull() | (margin >= 0.40), False).when((margin < 0.30) & (second != field), True).otherwise(rest)


def homogeneity_veto(least_adjacent: Column, ends: Column, least: float = 0.8) -> Column:
    """Unreadable samples count as contaminated."""
    return F.coalesce((least_adjacent < least) | (ends < least), F.lit(True))


def continuous(correlations: Column, least: float = 0.45) -> Column:
    """Whether the least of the readable correlations reaches `least`; none readable is continuous."""
    return F.coalesce(F.array_min(F.filter(correlations, lambda x: x.isNotNull())), F.lit(1.0)) >= least


def no_delivery(share: Column, active: Column) -> Column:
    """Whether motion is implausible for a delivery; an unknown share is plausible."""
    return F.coalesce((share < 0.40) | ((active < 1.4) & (share < 0.48)), F.lit(False))


#: Shots and prototypes of a source that meet in one block.
BLOCK = 2048


def framing_scores(shots: DataFrame, source: str = "source", prototype: Column | None = None, k: int = 3, least: int = 5, block: int = BLOCK) -> DataFrame:
    """(source, shot_id, others, framing_score): mean of the k best cosines with the source's other prototypes; null under `least` of them.

    shots: source, shot_id, embedding, margin, accepted. Prototypes are accepted shots with a margin of 0.6 or more.
    Both sides of a source with more than `block` shots are dealt into blocks; each pair of blocks keeps every shot's k best, which are then merged.
    """
    c = F.col
    held = shots.where(c("embedding").isNotNull())
    large = held.groupBy(c(source).alias("__s")).agg(F.count(F.lit(1)).alias("__n")).where(c("__n") > block).withColumn("__parts", F.ceil(c("__n") / block).cast("int")).drop("__n")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        """rows in a part of their own, copied to all parts of the other side; sources of one part have no row in `large`."""
        parts = F.coalesce(c("__parts"), F.lit(1)).cast("long")
        some = rows.join(F.broadcast(large), c(source) == c("__s"), "left")
        return some.select(source, "shot_id", "embedding", F.pmod(F.xxhash64("shot_id"), parts).alias(own), F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias(other))

    def best_of(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        """One pair of blocks: of each shot how many others it met and its k best cosines."""
        if not len(mine) or not len(theirs):
            return pd.DataFrame({source: [], "shot_id": [], "n": [], "best": []})
        a, b = (np.array(x.tolist(), np.float64) for x in (mine.embedding, theirs["__e"]))
        norms = np.outer(np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1))
        codes = pd.factorize(pd.concat([mine.shot_id, theirs["__id"]], ignore_index=True))[0]
        same = codes[: len(mine), None] == codes[None, len(mine) :]
        sims = np.nan_to_num(a @ b.T / np.maximum(norms, 1e-8), nan=-np.inf)
        sims[same] = -np.inf
        top = np.sort(sims, axis=1)[:, ::-1][:, :k]
        return pd.DataFrame({source: mine[source], "shot_id": mine.shot_id, "n": (~same).sum(axis=1), "best": [x[x > -np.inf].tolist() for x in top]})

    keys = [source, "__a", "__b"]
    proto = held.where(prototype if prototype is not None else c("accepted") & (c("margin") >= 0.6))
    left = dealt(held.where("accepted"), "__a", "__b").where(c(source).isNotNull())
    right = dealt(proto, "__b", "__a").where(c(source).isNotNull())
    right = right.select(c(source).alias("__s"), c("shot_id").alias("__id"), c("embedding").alias("__e"), c("__a").alias("__ra"), c("__b").alias("__rb"))
    types = {f.name: f.dataType.simpleString() for f in held.schema}
    each = left.groupBy(*keys).cogroup(right.groupBy("__s", "__ra", "__rb")).applyInPandas(best_of, f"`{source}` {types[source]}, shot_id {types['shot_id']}, n long, best array<double>").where("n > 0")
    merged = each.groupBy(source, "shot_id").agg(F.sum("n").alias("others"), F.flatten(F.collect_list("best")).alias("best"))
    score = F.round(vector.top_mean(c("best"), k), 4) + F.lit(0.0)
    return merged.select(source, "shot_id", "others", F.when(c("others") >= least, score).alias("framing_score"))


def with_framing(shots: DataFrame, scores: DataFrame, source: str = "source", cut: float = 0.90) -> DataFrame:
    """shots with accepted and reject_reason after the framing veto; shots without a score stay as they are."""
    out = shots.join(scores, [source, "shot_id"], "left")
    veto = F.col("accepted") & F.coalesce(F.col("framing_score") < cut, F.lit(False))
    reason = F.col("reject_reason") if "reject_reason" in shots.columns else F.lit(None).cast("string")
    return out.withColumn("reject_reason", F.when(veto, "framing_inconsistent").otherwise(reason)).withColumn("accepted", F.col("accepted") & ~veto)


def cascade(shots: DataFrame, closeup, homogeneity, least: float = 0.5) -> DataFrame:
    """shots with closeup and contaminated, each stage seeing only what the ones before it have left.

    closeup(rows) and homogeneity(rows) give (shot_id, flag); the first sees confident shots of the wanted view, the second those
    of them that are no close-up, so that the costly reading of frames is spared for all others.
    """
    wanted = shots.where((F.col("view_class") == VIEWS[0]) & (F.col("confidence") >= least))
    near = closeup(wanted).select("shot_id", F.col("flag").alias("homogeneous_closeup"))
    rest = wanted.join(near.where("homogeneous_closeup"), "shot_id", "left_anti")
    mixed = homogeneity(rest).select("shot_id", F.col("flag").alias("transition_contaminated"))
    no = F.lit(False)
    return shots.join(near, "shot_id", "left").join(mixed, "shot_id", "left").withColumns({c: F.coalesce(c, no) for c in ("homogeneous_closeup", "transition_contaminated")})
