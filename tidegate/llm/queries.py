"""Registered queries of the operators, with production parameters, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.llm import (
    common, decontaminate, language_id, mixing, nearest, negatives, ngram_lm, packing, pii, quality, secret_scan, simhash, spelling, substring_dedup)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op1_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    held_out = common.fold(10) == 0
    model = ngram_lm.train(docs.where(~held_out), order=3)
    scores = ngram_lm.score(docs, model, keep=["doc_id", held_out.alias("held_out")])
    return scores.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    levels = substring_dedup.repeated_windows(docs, min_words=13)
    return substring_dedup.remove_repeats(docs, levels, keep=["doc_id"], with_text=False)


ORACLES["op2_substring_dedup"] = r"""
with recursive words as (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
starts as (
  select r, doc_id, w, unnest(range(1, len(w) - 11)) as i from words),
windows as (
  select r, doc_id, i, sha256(array_to_string(w[i:i + 12], ' ')) as h from starts),
firsts as (
  select h, min(doc_id) as first from windows group by h having min(doc_id) < max(doc_id)),
hits as (
  select distinct r, i + k as i from windows join firsts using (h), range(13) as t(k) where first < doc_id),
places as (
  select r, doc_id, unnest(w) as word, generate_subscripts(w, 1) as i from words),
marked as (
  select p.r, p.word, p.i, h.i is not null as gone from places p left join hits h on p.r = h.r and p.i = h.i),
counted as (
  select r, sum(gone::int) as n_removed, string_agg(word, ' ' order by i) filter (where not gone) as kept from marked group by r),
doubled as (  -- windows that several documents hold, of 13 words, then of twice as many, and so on
  select r, doc_id, i, 13 as size, h, first from windows join firsts using (h)
  union all
  select r, doc_id, i, size, h, first from (
    select *, min(doc_id) over (partition by h) as first, max(doc_id) over (partition by h) as last from (
      select a.r, a.doc_id, a.i, 2 * a.size as size, sha256(a.h || b.h) as h from doubled a join doubled b on a.r = b.r and b.i = a.i + a.size))
  where first < last),
longest as (select r, max(size) as longest from doubled where first < doc_id group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256,
  coalesce(longest, 0)::bigint as longest_repeat
from words left join counted using (r) left join longest using (r)
"""


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"], with_ids=False)
    return pieces.drop("continues")


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    held_out = common.fold(4) == 2
    model = language_id.train(docs.where(~held_out))
    return language_id.predict(docs, model, keep=["doc_id", held_out.alias("held_out")])


@query
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (common.read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontaminate.scan(docs, benchmark, keep=["doc_id"]).drop("spans")


ORACLES["op9_decontaminate"] = r"""
with d as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bw as (
  select item_id, least(len(w), 10) as n, array_to_string(w[i:i + 9], ' ') as h
  from (select *, unnest(range(1, greatest(2, len(w) - 8))) as i from b where len(w) > 0)),
sizes as (select distinct n from bw),
dw as (
  select r, i, n, array_to_string(w[i:i + n - 1], ' ') as h
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes)),
hits as (select r, i, n, item_id from dw join bw using (n, h)),
covered as (select r, count(distinct i + k) as n_hit from (select distinct r, i, n from hits), range(10) as t(k) where k < n group by r),
items as (
  select r, count(*) as n_items, string_agg(cast(item_id as varchar), ',' order by cast(item_id as varchar)) as listed
  from (select distinct r, item_id from hits) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(listed, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (r) left join items using (r)
"""


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(common.read_table(spark, sf_dir, "documents"))


@query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, keep=["doc_id"], words=secret_scan.learned_words(docs))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_value")


@query
def op8_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(common.read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op7_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (common.read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    held_out = common.fold(4) == 2
    model = quality.train(docs.where(~held_out), labels.where(~held_out))
    return quality.score(docs, model, keep=["doc_id", held_out.alias("held_out")])


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(common.read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", *(f"n_{k}" for k in pii.KINDS[: pii.BASE]), "base_sha256", "spans", "n_added")


@query
def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(common.read_table(spark, sf_dir, "documents"), keep=["doc_id"])
    first, again = (F.try_element_at("passes", F.lit(i))["position"] for i in (1, 2))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", first.alias("position"), again.alias("position_again"))


ORACLES["op11_mixing"] = r"""
with docs as (
  select doc_id, source, md5(coalesce(doc_id::varchar, '') || ':mix') as key, coalesce(doc_id::varchar, '') as id,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents),
totals as (select source, sum(size)::bigint as source_size from docs group by source),
placed as (
  select source, source_size, row_number() over (order by source nulls last) - 1 as place from totals),
weighed as (
  select *, [5e0, 2e0, 1e0][place % 3 + 1] as weight, source_size * 2e0 as cap from placed),
filled as (
  select *, coalesce(sum(cap) over earlier, 0) as before_cap, sum(weight) over () - coalesce(sum(weight) over earlier, 0) as left_weight,
    sum(source_size) over () * 1.5e0 as budget
  from weighed window earlier as (order by cap / weight, place rows between unbounded preceding and 1 preceding)),
level as (
  select before_cap, left_weight from filled where weight * (budget - before_cap) / left_weight <= cap order by cap / weight, place limit 1),
goals as (
  select f.source, f.source_size, f.place, coalesce(least(cap, weight * (budget - l.before_cap) / l.left_weight), cap) as target
  from filled f left join level l on true),
ordered as (
  select d.*, g.source_size, g.place, g.target, floor(g.target)::bigint as wanted,
    coalesce(sum(size) over (partition by g.place order by key, id, size rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from docs d join goals g on d.source is not distinct from g.source),
met as (
  select doc_id, size, source_size, target, place, wanted, start,
    greatest(0, least(size, wanted - start)) as words, greatest(0, least(size, wanted - start - source_size)) as words_again
  from ordered),
curve(turn, total, low, high, a, v, slope) as (values
  (0, 0.8125e0, 0e0, 0.5e0, 0e0, 1e0, 0e0), (0, 0.8125e0, 0.5e0, 0.8125e0, 0.5e0, 1e0, -1.5e0),
  (1, 1e0, 0e0, 1e0, 0e0, 1e0, 0e0),
  (2, 0.5e0, 0e0, 0.03125e0, 0e0, 0e0, 1e0), (2, 0.5e0, 0.03125e0, 0.5e0, 0.25e0, 0.25e0, 1e0)),
times as (
  select m.*, f.asked - f.low as more, f.a, f.v, f.slope, g.asked - g.low as more_again, g.a as a_again, g.v as v_again, g.slope as slope_again
  from met m
  left join (select distinct turn, total, low, high, a, v, slope, place, start, wanted, start::double / wanted::double * total as asked
             from curve join met on turn = place % 3 where words > 0) f
    on m.words > 0 and f.place = m.place and f.start = m.start and f.low <= f.asked and f.asked < f.high
  left join (select distinct turn, total, low, high, a, v, slope, place, start, wanted, (start + source_size)::double / wanted::double * total as asked
             from curve join met on turn = place % 3 where words_again > 0) g
    on m.words_again > 0 and g.place = m.place and g.start = m.start and g.low <= g.asked and g.asked < g.high)
select doc_id, size, source_size, target, (words + words_again)::bigint as taken,
  case when words > 0 then case when more <= 0 then a else a + 2e0 * more / (v + sqrt(greatest(0e0, v * v + 2 * slope * more))) end end as position,
  case when words_again > 0 then case when more_again <= 0 then a_again
    else a_again + 2e0 * more_again / (v_again + sqrt(greatest(0e0, v_again * v_again + 2 * slope_again * more_again))) end end as position_again
from times
"""


@query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.usual_forms(common.read_table(spark, sf_dir, "documents"))


ORACLES["op12_spelling"] = r"""
with recursive bytes as (
  select list(crc order by i) as crcs from (
    select i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end) as crc
    from (select unnest(range(256))::bigint as i))),
runs as (
  select doc_id, run, count(*) as n from (
    select coalesce(doc_id::varchar, '') as doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) as run from documents)
  where length(run) >= 5 group by all),
summed as (
  select run, n, hex(encode(doc_id || ':' || run)) as h from runs),
checked as (
  select run, n, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length(h)::bigint, 2),
      lambda i: (strpos('0123456789ABCDEF', h[i]) - 1) * 16 + strpos('0123456789ABCDEF', h[i + 1]) - 1)),
    lambda c, b: xor(c >> 8, crcs[xor(c, b) % 256 + 1])), 4294967295::bigint) as crc
  from summed, bytes),
vocabulary as (
  select word, sum(n)::bigint as n from (
    select case when crc % 97 = 0 then run[1:crc % length(run)] || run[crc % length(run) + 2:] else run end as word, n from checked)
  where length(word) >= 5 group by word having sum(n) >= 3),
ascii as (
  select string_agg(chr((192 + i)::int), '' order by i) as letters, string_agg(chr((33 + i)::int), '' order by i) as others from range(64) as t(i)),
shorter as (  -- words at one error have a word with at most one letter left out in common
  select word, n, plain, unnest(list_distinct(list_prepend(plain, list_transform(range(1, length(plain) + 1), lambda i: plain[:i - 1] || plain[i + 1:])))) as part
  from (select word, n, translate(word, letters, others) as plain from vocabulary, ascii)),
near as (
  select distinct a.word, a.n, b.word as other, b.n as other_n from shorter a join shorter b on a.part = b.part and a.word != b.word
  where levenshtein(a.plain, b.plain) = 1),
best as (
  select word, any_value(n) as n, count(*) as n_near, arg_min(other, (-other_n, other)) as other, max(other_n) as other_n from near group by word),
forms as (
  select v.word, v.n, coalesce(n_near, 0)::bigint as n_near, case when other_n >= 2 * v.n then other end as form,
    case when other_n >= 2 * v.n then other_n end as form_n from vocabulary v left join best b on v.word = b.word),
steps as (
  select word, word as here, 0 as depth from forms
  union all select s.word, f.form, depth + 1 from steps s join forms f on s.here = f.word where f.form is not null)
select f.word, f.form, s.root, f.n, f.n_near, f.form_n
from forms f join (select word, arg_max(here, depth) as root from steps group by word) s on f.word = s.word
"""


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.read_table(spark, sf_dir, "embeddings")
    whole = F.transform("embedding", lambda x: F.when(~F.isnan(x) & (F.abs(x) != float("inf")), F.floor(x.cast("double") * 256)))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors, F.col("vec_id") % 100 == 0, vector=whole, label=label)


ORACLES["op13_hard_negatives"] = r"""
with vectors as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(x::double * 256)) as v
  from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
  from vectors a join vectors b on a.vec_id % 100 = 0 and a.vec_id != b.vec_id),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, positive_id, row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id)::int as rank,
  vec_id as negative_id, positive_score, score as negative_score
from positives p join scores n on p.anchor_id = n.anchor_id and not same and 80 * positive_score <= 100 * score and score <= positive_score
qualify rank <= 5
"""
