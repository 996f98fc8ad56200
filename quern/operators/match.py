"""Matching against a small set of profiles, and joins with state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern import scratch
from quern.functions import vectors as V
from quern.operators import similar

THRESHOLD = 0.3
NAME_RATIO = 0.65
#: Profiles that one expression scores; more are scored in as many expressions as it takes.
PROFILES_AT_ONCE = 64
#: Profiles that are fetched at most; their number is looked at first.
MOST_PROFILES = 1024


def profile_scores(vector: Column, profiles: list[tuple[int, list[float]]]) -> list[Column]:
    """For each block of profiles an array of (similarity, -position, profile_id)."""
    own = V.norm(vector)
    out = []
    for first in range(0, len(profiles), PROFILES_AT_ONCE):
        block = []
        for k, (name, values) in enumerate(profiles[first : first + PROFILES_AT_ONCE], first):
            length = sum(x * x for x in values) ** 0.5
            score = V.cosine(vector, F.array(*[F.lit(float(x)) for x in values]), own, F.lit(length))
            block.append(F.struct(score.alias("similarity"), F.lit(-k).alias("back"), F.lit(name).cast("long").alias("profile_id")))
        out.append(F.array(*block))
    return out


def best_profile(df: DataFrame, vector: str, profiles: DataFrame, profile_id: str = "profile_id", profile_vector: str = "embedding") -> DataFrame:
    """Adds best_profile and similarity: the profile of the largest cosine, the first on ties; null for a zero vector.

    profiles is a small table by its meaning (a person's few resumes): it is read once and becomes part of the
    expression, so nothing is joined or shuffled."""
    rows = profiles.orderBy(profile_id).limit(MOST_PROFILES + 1).select(profile_id, F.col(profile_vector).cast("array<double>").alias("v")).collect()
    if len(rows) > MOST_PROFILES:
        raise ValueError(f"more than {MOST_PROFILES} profiles")
    scores = profile_scores(F.col(vector), [(r[0], list(r["v"])) for r in rows])
    if not scores:
        return df.withColumns({"best_profile": F.lit(None).cast("long"), "similarity": F.lit(None).cast("double")})
    usable = [F.array_max(F.filter(s, lambda x: x["similarity"].isNotNull() & ~F.isnan(x["similarity"]))) for s in scores]
    best = F.greatest(*usable) if len(usable) > 1 else usable[0]
    return df.withColumn("_best", best).withColumns({"best_profile": F.col("_best.profile_id"), "similarity": F.col("_best.similarity")}).drop("_best")


def shortlist(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows whose similarity reaches the threshold, on the unrounded value."""
    return df.where(F.col("similarity") >= threshold)


def only_new(df: DataFrame, history: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Rows whose key is not in the history, the first of each key in the input's order."""
    from quern.operators.dedup import first_of

    return first_of(df, [key], order).join(history.select(key).distinct(), key, "left_anti")


def with_default(df: DataFrame, results: DataFrame, key: str, value: str, default: Column) -> DataFrame:
    """Left join with a default where there is no result, and needs_fallback to tell those rows."""
    found = results.select(F.col(key), F.col(value).alias("_value"))
    joined = df.join(found, key, "left")
    return joined.withColumns({"needs_fallback": F.col("_value").isNull(), value: F.coalesce("_value", default)}).drop("_value")


def _names(df: DataFrame, name: str, out: str) -> DataFrame:
    from quern.functions.text import normalise_name

    return df.withColumn(out, normalise_name(F.col(name))).where(F.col(out) != "")


def name_join(left: DataFrame, right: DataFrame, left_name: str, right_name: str, gram: int = 3) -> DataFrame:
    """Pairs of rows whose cleaned names contain one another, found without a cross join. Empty and null names match nothing.

    Distinct names are paired first. The shorter name's first `gram` characters occur in the longer one, so both are keyed by
    them: one row for a name as the contained one, one for each place of it as the container. Only names shorter than
    `gram`, if there are any, make the containers' shorter pieces keys as well."""
    a, b = _names(left, left_name, "_a"), _names(right, right_name, "_b")
    pairs = contained(a.select("_a").distinct(), b.select("_b").distinct(), "_a", "_b", gram)
    swapped = contained(b.select("_b").distinct(), a.select("_a").distinct(), "_b", "_a", gram).where("_a != _b")
    both = pairs.unionByName(swapped)
    return a.join(both, "_a").join(b, "_b").select(*left.columns, *right.columns)


def contained(inner: DataFrame, outer: DataFrame, a: str, b: str, gram: int) -> DataFrame:
    """(a, b) of distinct names, a contained in b."""
    lengths = sorted(r[0] for r in inner.select(F.least(F.length(a), F.lit(gram))).distinct().collect())  # gram values at most
    none = F.array().cast("array<string>")

    def pieces(n: int) -> Column:
        last = F.length(b) - n + 1
        return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda p: F.substr(F.col(b), p, F.lit(n)))).otherwise(none)

    every = F.array_distinct(F.flatten(F.array(*map(pieces, lengths)))) if lengths else none
    keyed = outer.select(b, F.explode(every).alias("_g"))
    return inner.withColumn("_g", F.substring(a, 1, gram)).join(keyed, "_g").where(F.contains(F.col(b), F.col(a))).select(a, b)


def fuzzy_name_pairs(left: DataFrame, right: DataFrame, left_name: str, right_name: str, ratio: float = NAME_RATIO) -> DataFrame:
    """(left_text, right_text, ratio) of distinct cleaned names that match: one contains the other, or the similarity ratio is
    `ratio` or more. ratio is exact for both kinds. Empty and null names match nothing."""
    from quern.operators.dedup import similarity

    a, b = (_names(df, name, "text").select("text").distinct() for df, name in ((left, left_name), (right, right_name)))
    ids = [scratch.stored(df.withColumn("id", F.monotonically_increasing_id()), "names") for df in (a, b)]
    near = similar.similar_pairs(ids[0], ids[1], [], ratio).drop("ratio")
    names = [df.withColumnsRenamed({"id": f"{side}_id", "text": f"{side}_text"}) for df, side in zip(ids, ("left", "right"), strict=True)]
    named = near.join(names[0], "left_id").join(names[1], "right_id").select("left_text", "right_text")
    a, b = names[0].select("left_text"), names[1].select("right_text")
    inside = contained(a, b, "left_text", "right_text", 3).unionByName(contained(b, a, "right_text", "left_text", 3))
    pairs = named.unionByName(inside).distinct()
    return pairs.withColumn("ratio", similarity(F.col("left_text"), F.col("right_text")))


def fuzzy_first(left: DataFrame, right: DataFrame, left_name: str, right_name: str, order: list[Column], ratio: float = NAME_RATIO) -> DataFrame:
    """Each left row with the first right row, in `order` (of right columns, unique), whose name matches as in fuzzy_name_pairs; left
    rows without a match are left out. Columns: those of both sides, which must differ in name, and ratio.

    The first right row of each right name is found before names are joined, so a name that many rows have is joined as one."""
    from quern.operators.dedup import first_of

    pairs = fuzzy_name_pairs(left, right, left_name, right_name, ratio)
    firsts = first_of(_names(right, right_name, "right_text"), ["right_text"], order)
    best = first_of(pairs.join(firsts, "right_text"), ["left_text"], order)
    found = _names(left, left_name, "left_text").join(best, "left_text")
    return found.select(*left.columns, *right.columns, "ratio")
