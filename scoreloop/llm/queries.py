"""The registered queries of the llm operators, one per operator and contract."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoreloop.llm import bpe, crf, ego, grulm, langid, mixing, phrases, pieces, rules, sharding, simhash, suffix, whitening
from scoreloop.llm.common import read, rest

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name):
    def add(f):
        QUERIES[name] = f
        return f
    return add


@query("op8_quality_rules")
def op8_quality_rules(spark, sf_dir):
    led = rules.ledger(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return rules.apply_policy(led, rules.STRICT).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        rules.failed(rules.BASE).alias("base_failed"), "kept", "fail_bits", "n_lines", "n_upper", "n_bangs")


@query("op3_shard_hypergeometric")
def op3_shard_hypergeometric(spark, sf_dir):
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    return sharding.shard(docs, n_shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op6_mix_sainte_lague")
def op6_mix_sainte_lague(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", mixing.n_words().alias("size"))
    return mixing.plan(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "rounds")


@query("op5_simhash_gray")
def op5_simhash_gray(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, size=3, max_bits=3).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op9_language_hierarchy")
def op9_language_hierarchy(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(rest("doc_id", 3) == 1, F.lit(False))
    model = langid.fit(docs.filter(rest("doc_id", 3) != 1))
    return (langid.predict(docs, model, ["doc_id"])
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score"))


@query("op1_quality_crf")
def op1_quality_crf(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = (read(spark, sf_dir, "labels").filter((rest("doc_id", 5) != 0) & F.col("quality").isNotNull())
              .groupBy("doc_id").agg(F.max("quality").alias("label")))
    model = crf.fit(docs, labels)
    held_out = F.coalesce(rest("doc_id", 5) == 0, F.lit(False))
    return crf.score(docs, model, ["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_lines", "bad_lines")


@query("op10_gru_lm")
def op10_gru_lm(spark, sf_dir):
    train = F.coalesce(rest("doc_id", 7) != 2, F.lit(False))
    held_out = F.coalesce(rest("doc_id", 7) == 2, F.lit(False))
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", train.alias("train"))
    return grulm.score_documents(docs).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op2_embedding_ego")
def op2_embedding_ego(spark, sf_dir):
    return ego.near_duplicates(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), cosine=0.9)


def public_vocabulary(name="byte_bpe_multi_50k.tiktoken"):
    """(bytes of the rank file, pattern) of an installed public tokenizer."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read(), public_tokenizers.PATTERN


@query("op7_bpe_duckdb")
def op7_bpe_duckdb(spark, sf_dir):
    vocabulary, pattern = public_vocabulary()
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, vocabulary, pattern, ["doc_id"], decoded=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.remove_repeats(docs, ["doc_id"], length=400).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.coalesce("kept", F.lit(b"")), 256).alias("kept_sha256"))


@query("op11_phrase_quicksort")
def op11_phrase_quicksort(spark, sf_dir):
    return phrases.collocations(read(spark, sf_dir, "documents").select("text", "lang"))


def public_file(name):
    """Bytes of a file of an installed public tokenizer."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


@query("op12_sentencepiece_offsets")
def op12_sentencepiece_offsets(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, public_file("piece_bpe_32k.model"), ["doc_id"], decoded=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
        F.element_at("bounds", -1).cast("long").alias("covered_bytes"))


@query("op13_whitening_qdwh")
def op13_whitening_qdwh(spark, sf_dir):
    return whitening.whiten(read(spark, sf_dir, "embeddings").select("vec_id", "embedding")).withColumn(
        "deviation", F.expr("try_cast(deviation as long)"))


SQL["op11_phrase_quicksort"] = r"""
with t as (
  select row_number() over () as d, coalesce(lang, 'und') as lang,
         regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') as ps from documents),
p as (
  select d, lang, i, list_filter(regexp_split_to_array(ps[i], '[\x20\x09]+'), lambda x: x <> '') as w from (select d, lang, ps, unnest(range(1, len(ps) + 1)) as i from t)),
totals as (select lang, sum(len(w))::hugeint as n from p group by lang),
starts as (select lang, w, unnest(range(1, len(w) + 1)) as s from p),
grams as (select lang, w, s, unnest(range(1, least(5, len(w) - s + 1) + 1)) as m from starts),
f as (select lang, m, array_to_string(w[s:s + m - 1], ' ') as g, count(*)::hugeint as c from grams group by all having count(*) >= 100),
cand as (select lang, m, g, c as a, string_split(g, ' ') as w from f where m > 1),
inside as (
  select lang, array_to_string(w[s:s + m2 - 1], ' ') as g, max(a) as longer
  from (select *, unnest(range(1, m - m2 + 2)) as s from (select *, unnest(range(2, m)) as m2 from cand where m > 2)) group by all),
kept as (
  select c.* from cand c left join inside i on c.lang = i.lang and c.g = i.g where i.longer is null or 100 * i.longer < 100 * c.a),
cuts as (select *, array_to_string(w[1:k], ' ') as lg, array_to_string(w[k + 1:], ' ') as rg from (select *, unnest(range(1, m)) as k from kept)),
s as (
  select cuts.lang, cuts.g, a, k, x.c as l, y.c as r, n, (1000 * a * n) // (x.c * y.c) as score
  from cuts join f x on x.lang = cuts.lang and x.g = cuts.lg join f y on y.lang = cuts.lang and y.g = cuts.rg join totals t on t.lang = cuts.lang),
best as (select * from s qualify row_number() over (partition by lang, g order by score, k) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, encode(g))::bigint as rank, g as phrase,
       a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from best qualify row_number() over (partition by lang order by score desc, a desc, encode(g)) <= 2000
"""

SQL["op6_mix_sainte_lague"] = r"""
with d as (
  select doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::bigint as size,
         md5('6-' || coalesce(doc_id::varchar, '')) as k from documents),
s0 as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as sid from d group by source),
s1 as (select *, [5.0::double, 2.0::double, 1.0::double][sid % 3 + 1] as weight, source_size * 3.0::double as lim from s0),
s2 as (
  select *, coalesce(sum(lim) over before, 0) as filled, coalesce(sum(weight) over before, 0) as used,
         sum(source_size) over () as words, sum(weight) over () as weights
  from s1 window before as (order by lim / weight, sid rows between unbounded preceding and 1 preceding)),
s3 as (select *, (words - filled) / (weights - used) as level from s2),
s4 as (select *, (select x.level from s3 x where x.lim > x.weight * x.level order by x.lim / x.weight, x.sid limit 1) as fair from s3),
tgt as (select source, source_size, sid, least(lim, coalesce(weight * fair, lim)) as target from s4),
seats as (
  select sid, row_number() over (order by target / (2 * k + 1) desc, sid) as place
  from (select sid, target, unnest(range(0, (target / 16)::bigint + 2 + (select count(*) from tgt))) as k from tgt)),
quota as (
  select sid, count(*) filter (place <= (select round(sum(target) / 16) from tgt)) as blocks from seats group by sid),
plan as (
  select t.*, least(blocks * 16, source_size * 3) as goal, greatest((source_size + 15) // 16, 1) as n_blocks
  from tgt t join quota q on t.sid = q.sid),
pick as (
  select *, case when source_size = 0 then 0 else goal // source_size end as rounds,
         case when source_size = 0 then 0 else round((goal - (goal // source_size) * source_size) / 16.0)::bigint end as extra,
         list_filter([1299709, 1299721, 1299743], lambda p: n_blocks % p <> 0)[1]::bigint as mul,
         (('0x' || substr(md5('6-' || sid::varchar), 1, 8))::bigint) % n_blocks as add
  from plan),
line as (
  select *, coalesce(sum(size) over (partition by source order by k, doc_id, size rows between unbounded preceding and 1 preceding), 0)::bigint as pos
  from d)
select l.doc_id, l.size, p.source_size, p.target,
       (p.rounds * l.size + case when l.size > 0 and p.extra > 0 then coalesce(list_sum(list_transform(
          list_filter(range(pos // 16, (pos + size - 1) // 16 + 1), lambda b: (mul * b + add) % n_blocks < extra),
          lambda b: least((b + 1) * 16, pos + size) - greatest(b * 16, pos))), 0) else 0 end)::bigint as taken,
       l.source, p.rounds::bigint as rounds
from line l join pick p on l.source is not distinct from p.source
"""

SQL["op8_quality_rules"] = r"""
with t as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
starts as (select r, unnest(range(1, len(w) - 6)) as i, w from t where len(w) >= 8),
grams as (select r, i, array_to_string(w[i:i + 7], ' ') as g from starts),
again as (select r, i, count(*) over (partition by r, g) as n from grams),
covered as (
  select r, sum(least(8, coalesce(lead_i - i, 8))) as n_repeat
  from (select r, i, lead(i) over (partition by r order by i) as lead_i from again where n > 1) group by r),
m as (
  select t.r, doc_id, len(w)::bigint as n_words, array_to_string(w, '') as j,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l,
         coalesce(n_repeat, 0)::bigint as n_repeat_words
  from t left join covered c on t.r = c.r),
q as (
  select doc_id, n_words, length(j)::bigint as word_chars, length(regexp_replace(j, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
         len(l)::bigint as n_lines, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, n_repeat_words,
         length(regexp_replace(j, '[^\p{Lu}]+', '', 'g'))::bigint as n_upper, (length(j) - length(replace(j, '!', '')))::bigint as n_bangs
  from m),
b as (
  select *, (case when n_words < 20 then 1 else 0 end + case when 100 * n_repeat_words > 30 * n_words then 2 else 0 end
    + case when 10 * n_symbols > 3 * n_words then 4 else 0 end + case when n_lines >= 4 and 10 * n_dup_lines > 3 * n_lines then 8 else 0 end
    + case when word_chars > 25 * n_words then 16 else 0 end + case when n_words >= 8 and 2 * n_upper > word_chars then 32 else 0 end
    + case when 5 * n_bangs > n_words then 64 else 0 end)::bigint as fail_bits
  from q)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 as base_failed,
       fail_bits = 0 as kept, fail_bits, n_lines, n_upper, n_bangs
from b
"""
