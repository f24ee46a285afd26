"""Language detection as a Spark job.

Naive Bayes over lower-case character 3-grams with add-0.5 smoothing and
a uniform prior; ties go to the alphabetically first language. Texts
without any known 3-gram get no language ("detection failed").

Plan: the profile is one grouping of exploded grams; scoring explodes each
text's grams, joins the (size-checked, broadcast) profile map-side and sums
per text -- partial aggregation collapses a text's rows before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloop.functions.tokens import char_trigrams
from scoreloop.operators.sizing import bounded_lookup, materialize

SMOOTH = 0.5


def _grams(df: DataFrame, key: str, text: str, *keep: str) -> DataFrame:
    # project the text away before exploding: each gram row carries only keys
    return df.select(key, *keep, F.explode(char_trigrams(text)).alias("gram"))


def profile_counts(train: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, n): gram counts per language over the labelled texts."""
    t = train.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    g = t.select(F.col(lang).alias("lang"), F.explode(char_trigrams(text)).alias("gram"))
    return g.groupBy("lang", "gram").agg(F.count("*").cast("long").alias("n"))


def languages(counts: DataFrame) -> list[str]:
    """The profile's language codes (a handful of values)."""
    return sorted(r[0] for r in counts.select("lang").distinct().collect())


def profile_logp(counts: DataFrame) -> DataFrame:
    """(lang, gram, n, logp) for the grams seen per language:
    logp = ln((n + 0.5) / (T_lang + 0.5 V))."""
    v = counts.select(F.count_distinct("gram")).scalar()
    totals = counts.groupBy("lang").agg(F.sum("n").alias("t"))
    return counts.join(totals, "lang").select(
        "lang", "gram", "n",
        (F.log(F.col("n") + SMOOTH) - F.log(F.col("t") + SMOOTH * v)).alias("logp"))


def profile_wide(counts: DataFrame, langs: list[str]) -> DataFrame:
    """One row per known gram with a log-probability column per language
    (unseen in a language -> smoothed count 0.5)."""
    v = counts.select(F.count_distinct("gram")).scalar()
    # languages by their place in the sorted list: a code may hold any character
    place = F.create_map(*[F.lit(x) for k, lg in enumerate(langs) for x in (lg, k)])
    by = counts.withColumn("_k", place[F.col("lang")])
    codes = list(range(len(langs)))
    wide = by.groupBy("gram").pivot("_k", codes).agg(F.first("n"))
    tot = by.groupBy().pivot("_k", codes).agg(F.sum("n"))
    totals = tot.select(F.struct(*[F.col(f"`{k}`").alias(f"t{k}") for k in codes])).scalar()
    cols = [F.col("gram")]
    for k in codes:
        cols.append((F.log(F.coalesce(F.col(f"`{k}`"), F.lit(0)) + SMOOTH) - F.log(totals[f"t{k}"] + SMOOTH * v)).alias(f"lp_{k}"))
    return wide.select(*cols)


def prepare_profile(wide_profile: DataFrame) -> DataFrame:
    """Materialise the profile once (checkpoint) and mark it for broadcast if
    its counted size allows; reuse the result across many detections."""
    from scoreloop.operators.langprofile import Profile

    return wide_profile if isinstance(wide_profile, Profile) else bounded_lookup(wide_profile)


def detect(df: DataFrame, wide_profile: DataFrame, langs: list[str], key: str = "id",
           text: str = "text", prepared: bool = False) -> DataFrame:
    """(key, detected_lang) for every key that has at least one known gram (with a ``Profile``: for every row)."""
    from scoreloop.operators.langprofile import Profile, detect_rows

    if isinstance(wide_profile, Profile):
        return detect_rows(df, wide_profile, text, "detected_lang", key)
    prof = wide_profile if prepared else bounded_lookup(wide_profile)
    # one row per (text, gram) before the join: beyond the broadcast bound the
    # shuffle join moves distinct grams, not every character
    counts = _grams(df, key, text).groupBy(key, "gram").agg(F.count("*").alias("c"))
    g = counts.join(prof, "gram")
    sums = g.groupBy(key).agg(*[F.sum(F.col(f"lp_{k}") * F.col("c")).alias(f"s_{k}") for k, lg in enumerate(langs)])
    ranked = F.sort_array(F.array(*[F.struct((-F.col(f"s_{k}")).alias("neg"), F.lit(lg).alias("lang"))
                                    for k, lg in enumerate(langs)]))
    return sums.select(key, ranked[0]["lang"].alias("detected_lang"))


def with_language(df: DataFrame, wide_profile: DataFrame, langs: list[str], key: str = "id",
                  text: str = "text", out: str = "detected_lang", prepared: bool = False,
                  unique_keys: bool = False) -> DataFrame:
    """Add the detected language to every row (null when detection fails).

    Detection runs once per distinct key; when ``df`` is already
    partitioned by ``key`` (e.g. after a dedup on it) the join adds no shuffle.
    """
    from scoreloop.operators.langprofile import Profile, detect_rows

    if unique_keys and isinstance(wide_profile, Profile):  # every row is a text of its own: no join
        return detect_rows(df, wide_profile, text, out, *df.columns)
    src = df.select(key, text)
    if not unique_keys:          # copies of a text are detected once: one of a key's texts, without a sort of the texts
        src = src.groupBy(key).agg(F.any_value(text).alias(text))
    d = detect(src, wide_profile, langs, key, text, prepared)
    return df.join(d.withColumnRenamed("detected_lang", out), key, "left")


def language_reason(detected: str = "detected_lang", wanted: str = "en"):
    """C3: 'detection failed' / 'not English' / null (accepted)."""
    d = F.col(detected)
    return F.when(d.isNull(), "detection failed").when(d != wanted, "not English")


def train_profile(docs: DataFrame, text: str = "text", lang: str = "lang"):
    """Languages and the wide profile from labelled documents. The gram
    counts are materialised once (checkpoint): the vocabulary size, the
    per-language totals and the pivot all read them."""
    counts = materialize(profile_counts(docs, text, lang))
    langs = languages(counts)
    return profile_wide(counts, langs), langs


def stored(docs: DataFrame, root: str | None = None, text: str = "text", lang: str = "lang"):
    """(profile, languages) from the stored profile of these rows: in arrays within the broadcast bound, else wide."""
    from scoreloop.operators import langprofile as LP

    profile = LP.Profile.load(LP.stored_profile(docs, root, text, lang))
    if profile is not None:
        return profile, profile.langs
    wide, langs = train_profile(docs, text, lang)
    return prepare_profile(wide), langs
