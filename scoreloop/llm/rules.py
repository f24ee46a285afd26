"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the
measurements and one long, ``fail_bits``, whose bit k says that rule k
failed. A policy is a named, versioned mask over the rules: applying it is
one ``&``; an ablation (what a rule alone rejects, what a policy would keep
without it) is an aggregation of masked bits. Native expressions only; no
shuffle: the ledger is a projection of the scan.

Null text counts as empty: no words, which fails ``few_words``.
Repeated rows get a ledger row each; an empty table gives an empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloop.llm.common import SPACE_CLASS, SPACES

#: Symbol characters counted by ``n_symbols``.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
PROBE = 4

#: (name, SQL condition on the measurements that makes the rule fail). The
#: position is the rule's bit; append only, so that stored ledgers keep their meaning.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 20"),
    ("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    ("symbol_share", "10 * n_symbols > 3 * n_words"),
    ("duplicate_lines", "n_lines >= 4 and 10 * n_dup_lines > 3 * n_lines"),
    ("long_words", "word_chars > 25 * n_words"),
    ("upper_case", "n_words >= 8 and 2 * n_upper > word_chars"),
    ("shouting", "5 * n_bangs > n_words"),
)
BIT = {name: k for k, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A versioned selection of rules; a document passes if none of them failed."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << BIT[r] for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
STRICT = Policy("strict", 1, ("few_words", "repeated_words", "symbol_share", "duplicate_lines", "long_words",
                              "upper_case", "shouting"))
POLICIES = (BASE, STRICT)


def _repeat_words() -> F.Column:
    """Words inside ``WINDOW``-word windows that occur twice or more.

    ``_w`` holds the words. A repeated window repeats its first ``PROBE``
    words, so only texts where two hashes of ``PROBE`` words agree have
    their whole windows sorted and compared. The flagged starts p1 < p2 < ... cover sum(min(8, gap)) + 8 words.
    """
    # element access is constant time; slice() would copy the whole array for every window
    first = ", ".join(f"get(h1, i + {k})" for k in range(PROBE))
    hashes = (f"transform(array(transform(_w, x -> xxhash64(x))), h1 -> "
              f"transform(sequence(0, size(_w) - {PROBE}), i -> xxhash64({first})))")
    starts_at = f"sequence(0, size(_w) - {WINDOW})"
    at = ", ".join(f"get(_w, i + {k})" for k in range(WINDOW))
    rows = f"sort_array(transform({starts_at}, i -> struct(concat_ws(' ', {at}) as g, i as p)))"
    # a window repeats if the sorted neighbour on either side equals it; array(x)[0] binds the sorted list once
    starts = (f"sort_array(filter(transform(array({rows}), s -> transform(s, (x, i) -> "
              "if((i > 0 and s[greatest(i - 1, 0)].g = x.g) or (i + 1 < size(s) and s[least(i + 1, size(s) - 1)].g = x.g), x.p, null)))[0], "
              "p -> p is not null))")
    covered = (f"transform(array({starts}), s -> aggregate(s, struct(0 as n, cast(null as int) as p), "
               f"(a, p) -> struct(a.n + if(a.p is null, 0, least({WINDOW}, p - a.p)) as n, p as p), "
               f"a -> a.n + if(a.p is null, 0, {WINDOW})))[0]")
    repeats = f"exists({hashes}, h -> size(array_distinct(h)) < size(h))"
    return F.expr(f"case when size(_w) <= {WINDOW} then 0L when {repeats} then cast({covered} as long) else 0L end")


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements the rules read (one pass over the text)."""
    t = F.coalesce(F.col(text), F.lit(""))
    # a line counts if it has a word; removing white space from both ends keeps "equal lines" equal only if the line is whole
    lines = F.expr(f"filter(split(_t, '\\n', -1), x -> trim(BOTH '{SPACES}' FROM x) <> '')")
    d = df.withColumn("_t", t).withColumn("_w", F.array_remove(F.split("_t", SPACE_CLASS + "+"), ""))
    d = d.withColumn("_l", lines).withColumn("_j", F.concat_ws("", "_w"))
    return (d.withColumn("n_words", F.size("_w").cast("long"))
            .withColumn("word_chars", F.char_length("_j").cast("long"))
            .withColumn("n_symbols", (F.char_length("_j") - F.char_length(F.regexp_replace("_j", f"[{SYMBOLS}]+", ""))).cast("long"))
            .withColumn("n_lines", F.size("_l").cast("long"))
            .withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
            .withColumn("n_repeat_words", _repeat_words())
            .withColumn("n_upper", (F.char_length("_j") - F.char_length(F.regexp_replace("_j", r"\p{Lu}+", ""))).cast("long"))
            .withColumn("n_bangs", (F.char_length("_j") - F.char_length(F.replace("_j", F.lit("!"), F.lit("")))).cast("long"))
            .drop("_t", "_w", "_l", "_j"))


def ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """Measurements and ``fail_bits`` of every row."""
    bits = [F.when(F.expr(cond), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, (_, cond) in enumerate(RULES)]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measure(df, text).withColumn("fail_bits", total)


def failed(policy: Policy) -> F.Column:
    """The policy rejects the row."""
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def apply_policy(led: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """The ledger with the policy's verdict: ``kept`` and the policy's name and version."""
    return (led.withColumn("kept", ~failed(policy))
            .withColumn("policy", F.lit(f"{policy.name}/{policy.version}")))


def ablation(led: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """Per policy and rule: rows failing it, rows that only it rejects, rows kept without it.

    One grouping of the ledger by ``fail_bits`` (at most 2^rules rows), then bit arithmetic.
    """
    sig = led.groupBy("fail_bits").agg(F.count("*").alias("n"))
    ps = F.array(*[F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"),
                            F.lit(p.mask).cast("long").alias("mask"),
                            F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << BIT[r]).cast("long").alias("bit"))
                                      for r in p.rules]).alias("rules")) for p in policies])
    x = sig.withColumn("p", F.explode(ps)).select("fail_bits", "n", "p.*").withColumn("r", F.explode("rules"))
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    without = hit.bitwiseAND(F.bitwise_not(F.col("r.bit")))
    return (x.groupBy("policy", "version", F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(hit.bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(hit == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only_this"),
                 F.sum(F.when(without == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
                 F.sum(F.when(hit == 0, F.col("n")).otherwise(0)).alias("n_kept")))
