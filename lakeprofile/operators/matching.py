"""Challenge-to-company matching and logistic scoring."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import reduce
from math import ceil
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import (
    COUNTRY_KEYWORDS,
    INDUSTRY_KEYWORDS,
    keyword_lookup,
    name_guess,
    word_jaccard,
)
from ..functions.vectors import clamp01, sigmoid
from ..session import cut_lineage, ship_package
from .ordering import top_n

# Model used when none is stored, and the blend weights.
DEFAULT_MODEL = {
    "coefficients": [0.5, 0.3, 0.2],
    "intercept": 0.0,
    "feature_order": ["embedding_similarity", "industry_match", "geo_match"],
}
SIMILARITY_WEIGHT, MODEL_WEIGHT = 0.7, 0.3
BLEND = {"embedding_similarity": 0.6, "industry_geo_score": 0.2, "apollo_score": 0.1, "ml_score": 0.1}
TOP_RESULTS = 20


def candidate_prefilter(
    candidates: DataFrame, equals: Mapping[str, str | None], limit: int | None = None, tie_breaker: str = "company_key"
) -> DataFrame:
    """Candidates with a vector that meet the given equalities, newest first.

    Absent filters (``None``) select everything.
    """
    out = candidates.where(F.col("embedding_vector").isNotNull())
    for column, value in equals.items():
        if value is not None:
            out = out.where(F.col(column) == F.lit(value))
    if limit is not None:
        out = out.orderBy(F.col("updated_at").desc(), F.col(tie_breaker).asc()).limit(limit)
    return out


def match_reason(similarity: Column, industry: Column, geo: Column, name: Column, ml: Column) -> Column:
    """Plain-language reasons joined by ``; ``."""
    parts = F.array_compact(
        F.array(
            F.when(similarity > 0.8, "Very high content similarity")
            .when(similarity > 0.6, "High content similarity")
            .when(similarity > 0.4, "Moderate content similarity"),
            F.when(industry > 0, "Industry match"),
            F.when(geo > 0, "Geographic match"),
            F.when(name > 0.5, "Company name similarity"),
            F.when(ml > 0.7, "Strong ML prediction").when(ml > 0.5, "Moderate ML prediction"),
        )
    )
    return F.when(F.size(parts) > 0, F.array_join(parts, "; ")).otherwise(F.lit("General similarity"))


def _unit_rows(vectors: pd.Series) -> np.ndarray:
    """Rows of one width scaled to length 1; zero vectors and vectors with a missing or infinite number become zero."""
    out = np.stack(vectors.to_list()).astype(float)
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, norms, out=np.zeros_like(out), where=(norms > 0) & np.isfinite(norms))


def _cosines(asked: pd.Series, offered: pd.Series) -> np.ndarray:
    """Cosine of every pair; 0 where one is missing or the widths differ, whatever else is in the batch."""
    out = np.zeros((len(asked), len(offered)))
    asked_width = asked.map(lambda v: 0 if v is None else len(v)).to_numpy(dtype=int)
    offered_width = offered.map(lambda v: 0 if v is None else len(v)).to_numpy(dtype=int)
    for width in np.unique(asked_width[asked_width > 0]):
        rows, cols = np.flatnonzero(asked_width == width), np.flatnonzero(offered_width == width)
        if len(cols):
            out[np.ix_(rows, cols)] = _unit_rows(asked.iloc[rows]) @ _unit_rows(offered.iloc[cols]).T
    return out


def _substring_matrix(wanted: pd.Series, offered: pd.Series) -> np.ndarray:
    """1.0 where a non-empty wanted label occurs in the offered text."""
    labels, label_of = np.unique(wanted.fillna("").to_numpy(dtype=str), return_inverse=True)
    texts, text_of = np.unique(offered.fillna("").str.lower().to_numpy(dtype=str), return_inverse=True)
    table = np.array([[float(bool(w) and w in t) for t in texts] for w in labels])
    return table[label_of][:, text_of]


ASKED = "q_row bigint, challenge_id string, q_vector array<double>, q_industry string, q_country string, q_name string"
OFFERED = "company_key string, company_name string, industry string, country string, vector array<double>"
SCORED = (
    "q_row bigint, challenge_id string, company_key string, company_name string, industry string, country string, "
    "q_name string, embedding_similarity double, industry_match double, geo_match double, "
    "ml_score double, final_score double"
)
#: Width of the vectors without a direction (all zero, or with a missing number); their cosine is 0.
NO_DIRECTION = -1
#: Width of the cell for vectors whose own width has no centre; it has no bound.
NO_CENTRE = -2
#: Angles and scores are compared with this much to spare, so that rounding prunes nothing.
SPARE = 1e-6


@dataclass(frozen=True)
class Weights:
    """Of the match model; ``similarity``, ``industry`` and ``geo`` in its sum."""

    similarity: float
    industry: float
    geo: float
    intercept: float

    def final(self, sim: np.ndarray, labels: np.ndarray | float) -> tuple[np.ndarray, np.ndarray]:
        """(model score, final score); ``labels`` is what the label matches add to the sum."""
        ml = 1.0 / (1.0 + np.exp(-(self.similarity * sim + labels + self.intercept)))
        return ml, SIMILARITY_WEIGHT * sim + MODEL_WEIGHT * ml

    def most(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """No pair with a cosine from ``low`` to ``high`` has a higher final score."""
        leaning = high if self.similarity >= 0 else low
        ml, _ = self.final(leaning, max(self.industry, 0.0) + max(self.geo, 0.0))
        return SIMILARITY_WEIGHT * high + MODEL_WEIGHT * ml


@dataclass
class Cell:
    """Candidates nearest to one centre: all lie ``low`` to ``high`` radians away from it."""

    width: int
    centre: np.ndarray | None
    low: float = 0.0
    high: float = np.pi
    rows: int = 0
    parts: int = 1


def _directions(vectors: pd.Series) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(width, positions, unit vectors) per width; vectors without a direction under ``NO_DIRECTION``."""
    widths = vectors.map(lambda v: 0 if v is None else len(v)).to_numpy(dtype=int)
    out, lost = [], [np.flatnonzero(widths == 0)]
    for width in np.unique(widths[widths > 0]):
        at = np.flatnonzero(widths == width)
        units = _unit_rows(vectors.iloc[at])
        there = units.any(axis=1)
        out.append((int(width), at[there], units[there]))
        lost.append(at[~there])
    return [*[o for o in out if len(o[1])], (NO_DIRECTION, np.concatenate(lost), np.empty((0, 0)))]


def _angles(units: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ centres.T, -1.0, 1.0))


def _assign(cells: list[Cell]):
    """Task function: every candidate with the cell of its nearest centre and the angle between them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cell, angle = np.zeros(len(batch), dtype="int32"), np.zeros(len(batch))
            for width, at, units in _directions(batch["vector"]):
                mine = [i for i, c in enumerate(cells) if c.width == width]
                if not mine or width == NO_DIRECTION:
                    cell[at] = next(i for i, c in enumerate(cells) if c.width == (NO_DIRECTION if width == NO_DIRECTION else NO_CENTRE))
                    continue
                away = _angles(units, np.stack([cells[i].centre for i in mine]))
                nearest = away.argmin(axis=1)
                cell[at], angle[at] = np.array(mine)[nearest], away[np.arange(len(at)), nearest]
            yield batch.assign(cell=cell, angle=angle)

    return run


def _route(cells: list[Cell], weights: Weights, k: int):
    """Task function: for every challenge the most a pair with each cell can score, and which cells come first.

    The first ones are those with the highest bounds that hold ``k`` candidates together.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        used = [i for i, c in enumerate(cells) if c.rows]
        rows = np.array([cells[i].rows for i in used])
        for batch in batches:
            if not used or batch.empty:
                continue
            free = np.array([float(cells[i].width == NO_CENTRE) for i in used])
            low, high = np.tile(-free, (len(batch), 1)), np.tile(free, (len(batch), 1))
            for width, at, units in _directions(batch["q_vector"]):
                mine = [n for n, i in enumerate(used) if cells[i].width == width != NO_DIRECTION]
                if mine and len(at):
                    away = _angles(units, np.stack([cells[used[n]].centre for n in mine]))
                    least = np.array([cells[used[n]].low for n in mine])
                    most = np.array([cells[used[n]].high for n in mine])
                    near = np.maximum(0.0, np.maximum(away - most, least - away) - SPARE)
                    high[np.ix_(at, mine)] = np.cos(near)
                    low[np.ix_(at, mine)] = np.cos(np.minimum(np.pi, away + most + SPARE))
            bound = weights.most(low, high) + SPARE
            order = np.argsort(-bound, axis=1, kind="stable")
            before = np.cumsum(rows[order], axis=1) - rows[order]
            first = np.zeros(bound.shape, dtype=bool)
            np.put_along_axis(first, order, before < k, axis=1)
            yield pd.DataFrame(
                {
                    "q_row": np.repeat(batch["q_row"].to_numpy(), len(used)), "cell": np.tile(np.array(used, dtype="int32"), len(batch)),
                    "parts": np.tile(np.array([cells[i].parts for i in used], dtype="int32"), len(batch)), "bound": bound.ravel(), "first": first.ravel(),
                }
            )

    return run


def _best_of(asked: pd.DataFrame, offered: pd.DataFrame, weights: Weights, k: int) -> pd.DataFrame:
    """Best ``k`` offered rows per asked row: one matrix product."""
    # the last digits of a product hang on the shape of the matrices, a tie must not
    sim = np.round(_cosines(asked["q_vector"], offered["vector"]), 12)
    ind = _substring_matrix(asked["q_industry"], offered["industry"])
    geo = _substring_matrix(asked["q_country"], offered["country"])
    ml, final = weights.final(sim, weights.industry * ind + weights.geo * geo)
    n = min(k, len(offered))
    worst = -np.partition(-final, n - 1, axis=1)[:, n - 1 :][:, :1]
    row, col = np.nonzero(final >= worst)
    keys = offered["company_key"].to_numpy(dtype=str)[col]
    order = np.lexsort((keys, -final[row, col], row))
    row, col = row[order], col[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    row, col = row[place < n], col[place < n]
    out = offered.iloc[col][["company_key", "company_name", "industry", "country"]].reset_index(drop=True)
    for column in ("q_row", "challenge_id", "q_name"):
        out[column] = asked[column].to_numpy()[row]
    for column, values in (("embedding_similarity", sim), ("industry_match", ind), ("geo_match", geo), ("ml_score", ml), ("final_score", final)):
        out[column] = values[row, col]
    return out[[f.split(" ")[0] for f in SCORED.split(", ")]]


def _score_parts(weights: Weights, k: int, at_once: int = 128):
    """Task function over rows in the order (cell, part, candidates before challenges).

    One part of bounded size is held, the challenges sent to it pass by.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, whole = None, [], None
        for batch in batches:
            for (cell, part, asks), rows in batch.groupby(["cell", "part", "asks"], sort=True):
                if (cell, part) != key:
                    key, held, whole = (cell, part), [], None
                if not asks:
                    held.append(rows)
                    continue
                whole = pd.concat(held, ignore_index=True) if whole is None and held else whole
                for start in range(0, len(rows) if whole is not None else 0, at_once):
                    yield _best_of(rows.iloc[start : start + at_once], whole, weights, k)

    return run


def _scored(sent: DataFrame, placed: DataFrame, weights: Weights, k: int) -> DataFrame:
    """Best ``k`` of every part for the challenges sent to its cell; each candidate is moved once, to its part."""
    asks = sent.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts").withColumn("asks", F.lit(1))
    visited = F.broadcast(sent.select("cell").distinct())  # as many rows as there are centres at most
    offers = placed.join(visited, "cell", "left_semi").withColumns({"asks": F.lit(0), "q_row": F.lit(-1).cast("long")})
    both = offers.unionByName(asks, allowMissingColumns=True).repartition("cell", "part")
    return both.sortWithinPartitions("cell", "part", "asks").mapInPandas(_score_parts(weights, k), SCORED)


def _place(offered: DataFrame, part_rows: int, centres: int) -> tuple[DataFrame, list[Cell]]:
    """Candidates with the cell of their nearest centre and a part of it, and the cells.

    Centres are vectors of candidates, those with the least digests per width.
    """
    widths = {r["width"]: r["n"] for r in offered.groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = min(centres, ceil(sum(widths.values()) / part_rows))
    marked = offered.select("vector", F.size("vector").alias("width"), F.xxhash64("vector").alias("_d"))
    least = top_n(marked.select("width", "_d").distinct(), ["width"], [F.col("_d").asc()], wanted)
    sample = marked.join(F.broadcast(least), ["width", "_d"], "left_semi").dropDuplicates(["width", "_d"]).toPandas()  # ``centres`` rows a width at most
    cells = [Cell(width, unit) for width, _, units in _directions(sample["vector"]) for unit in units]
    cells += [Cell(NO_DIRECTION, None), Cell(NO_CENTRE, None)]
    near = cut_lineage(offered.mapInPandas(_assign(cells), OFFERED + ", cell int, angle double"))
    for r in near.groupBy("cell").agg(F.min("angle").alias("low"), F.max("angle").alias("high"), F.count(F.lit(1)).alias("n")).collect():
        cell = cells[r["cell"]]
        cell.low, cell.high, cell.rows, cell.parts = r["low"], r["high"], r["n"], ceil(r["n"] / part_rows)
    parts = F.element_at(F.array(*[F.lit(c.parts) for c in cells]), F.col("cell") + 1)
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), parts).cast("int")
    return near.withColumn("part", part).drop("angle"), cells


def match_topk(
    challenges: DataFrame,
    candidates: DataFrame,
    model: Mapping = DEFAULT_MODEL,
    k: int = TOP_RESULTS,
    part_candidates: int = 20_000,
    centres: int = 256,
) -> DataFrame:
    """Best ``k`` candidates for every challenge, as if each were compared with all of them.

    Candidates go to the nearest of up to ``centres`` centres (one for
    ``part_candidates`` of them).  By the triangle inequality of angles a cell has a
    bound for the score of its candidates.  A challenge visits the cells with the
    highest bounds that hold ``k`` candidates, and then those whose bound reaches its
    ``k``-th score.  Cells are cut into parts of about ``part_candidates`` rows; a task
    holds one part while challenges stream by, so no list grows with either table.
    Ties go by key.  Vectors without a direction or of another width score 0.
    """
    by_name = dict(zip(model["feature_order"], model["coefficients"], strict=True))
    weights = Weights(*[float(by_name.get(f, 0.0)) for f in ("embedding_similarity", "industry_match", "geo_match")], float(model["intercept"]))
    ship_package(challenges.sparkSession)
    asked = cut_lineage(
        challenges.select(
            F.monotonically_increasing_id().alias("q_row"),
            F.col("challenge_id").cast("string").alias("challenge_id"),
            F.col("vector").cast("array<double>").alias("q_vector"),
            keyword_lookup("text", INDUSTRY_KEYWORDS).alias("q_industry"),
            keyword_lookup("text", COUNTRY_KEYWORDS).alias("q_country"),
            name_guess("text").alias("q_name"),
        )
    )
    offered = candidates.where(F.size("embedding_vector") > 0).select(
        "company_key", "company_name", "industry", "country", F.col("embedding_vector").cast("array<double>").alias("vector")
    )
    placed, cells = _place(offered, part_candidates, centres)
    routes = cut_lineage(asked.select("q_row", "q_vector").mapInPandas(_route(cells, weights, k), "q_row bigint, cell int, parts int, bound double, first boolean"))
    order = [F.col("final_score").desc(), F.col("company_key").asc()]
    near = cut_lineage(top_n(_scored(routes.where("first").join(asked, "q_row").drop("bound", "first"), placed, weights, k), ["q_row"], order, k, rank="rank"))
    found = near.drop("rank")
    if sum(c.rows > 0 for c in cells) > 1:  # otherwise the first cell was all
        least = near.where(F.col("rank") == k).select("q_row", F.col("final_score").alias("least"))
        open_routes = routes.where("NOT first").join(least, "q_row", "left").where(F.col("bound") >= F.coalesce("least", F.lit(float("-inf"))))
        found = found.unionByName(_scored(open_routes.join(asked, "q_row").drop("bound", "first", "least"), placed, weights, k))
    best = top_n(found, ["challenge_id"], order, k, rank="rank").drop("q_row")
    named = (F.col("q_name") != "") & (F.col("company_name") != "")
    similarity = F.when(named, word_jaccard(F.col("q_name"), F.lower("company_name"))).otherwise(F.lit(0.0))
    scores = [F.col(c) for c in ("embedding_similarity", "industry_match", "geo_match", "name_similarity", "ml_score")]
    return best.withColumn("name_similarity", similarity).withColumn("reason", match_reason(*scores)).drop("q_name")


def logistic_score(model: Mapping, features: Mapping[str, Column], categories: Mapping[str, Column] | None = None) -> Column:
    """Probability under a stored model; features it does not know count as 0.

    A feature ``industry_x`` is 1 where the ``industry`` category equals ``x``.
    """
    categories = categories or {}

    def value(name: str) -> Column:
        if name in features:
            return F.coalesce(features[name].cast("double"), F.lit(0.0))
        for prefix, column in categories.items():
            if name.startswith(f"{prefix}_"):
                wanted = name[len(prefix) + 1 :]
                return F.when(column == F.lit(wanted), F.lit(1.0)).otherwise(F.lit(0.0))
        return F.lit(0.0)

    pairs = zip(model["feature_order"], model["coefficients"], strict=True)
    terms = [value(name) * F.lit(float(w)) for name, w in pairs]
    return sigmoid(reduce(add, terms, F.lit(float(model["intercept"]))))


def blend_score(parts: Mapping[str, Column], weights: Mapping[str, float] = BLEND) -> dict[str, Column]:
    """Clamped weighted blend and the weighted share of every part."""
    shares = {f"{name}_weighted": F.lit(w) * parts[name] for name, w in weights.items()}
    total = reduce(add, shares.values())
    return {"final_score": clamp01(total), **shares}

