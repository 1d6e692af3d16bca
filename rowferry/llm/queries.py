"""The registered queries of the operators, and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowferry.llm import filter_audit, hyper_minhash, language_id, max_sketches, mixing, packing, page_difference
from rowferry.llm import quality_rules as quality
from rowferry.llm import rule_ensemble as ensemble
from rowferry.llm import secret_scan as secrets
from rowferry.llm import simhash, suffix_levels, vantage_points
from rowferry.llm.common import fold, read_table


def op1_quality_rules(spark, folder):
    return quality.quality_rules(read_table(spark, folder, "documents"))


OP1_SQL = r"""
with recursive docs as (
    select doc_id, coalesce(source, '') as host, md5(coalesce(text, '')) as text_key, coalesce(text, '') as text
    from documents
), words as (
    select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w,
        list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
    from docs
), places as (
    select doc_id, unnest(range(1, len(w) - 3)) as i, w from words where len(w) >= 5
), windows as (
    select doc_id, i, array_to_string(w[i : i + 4], ' ') as g from places
), again as (
    select doc_id, i from windows qualify count(*) over (partition by doc_id, g) > 1
), covered as (
    select doc_id, count(distinct p) as n from (
        select doc_id, unnest(range(i, i + 5)) as p from again) group by doc_id
), norm as (
    select host, text_key, list_transform(lines, lambda l: lower(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g')))) as lines
    from words group by all
), placed as (
    select host, text_key, unnest(range(1, len(lines) + 1)) as i, lines from norm
), line as (
    select host, text_key, i, lines[i] as l, case when i = 1 then null else lines[i - 1] end as a,
        case when i = len(lines) then null else lines[i + 1] end as b,
        len(string_split(lines[i], ' ')) as n
    from placed
), held as (
    select host, text_key, l, arg_min(coalesce(a, ''), i) as a, arg_min(coalesce(b, ''), i) as b
    from line group by all
), side as (
    select host, l, 0 as s, a as x from held union all select host, l, 1, b from held
), beside as (
    select host, l, s, x, count(*) as n from side group by all
), spread as (
    select host, l, s, sum(n) as n, max(n) as most, arg_max(x, n) as top from beside group by all
), hosts as (
    select host, count(*) as texts from norm group by host
), common as (
    select host, l, max(n) as n, min(most) * 2 <= max(n) as varied,
        max(case when s = 1 then top end) as next, max(case when s = 1 then most end) as together
    from spread join hosts using (host) group by host, l, texts having max(n) > 20 and 1000 * max(n) > texts
), links as (
    select a.host, a.l, b.l as other from common a join common b on a.host = b.host and a.next = b.l
    where 100 * a.together >= 90 * a.n and 100 * a.together >= 90 * b.n
), ways as (
    select * from links union all select host, other, l from links
), frequent as (
    select host, l from common where varied
    union
    select w.host, w.other from frequent f join ways w on w.host = f.host and w.l = f.l
), removed as (
    select host, text_key, sum(n) as n from line semi join frequent using (host, l) group by all
)
select *, not base_failed and n_removed_words <= 0.7 * n_words as kept from (
    select d.doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
        (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
        coalesce(c.n, 0)::bigint as n_repeat_words, coalesce(r.n, 0)::bigint as n_removed_words,
        len(w) < 10 or 100 * coalesce(c.n, 0) > 20 * len(w) as base_failed
    from words d left join covered c using (doc_id) left join removed r using (host, text_key))
"""


def op2_suffix_levels(spark, folder):
    return suffix_levels.remove_repeats(read_table(spark, folder, "documents"))


def op3_secret_scan(spark, folder):
    found = secrets.secret_scan(read_table(spark, folder, "documents"))
    of_kind = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        "doc_id", of_kind(0).alias("n_assign"), of_kind(1).alias("n_access"), of_kind(2).alias("n_hex"),
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"))


def op4_simhash(spark, folder):
    return simhash.simhash_groups(read_table(spark, folder, "documents"))


def op5_language_id(spark, folder):
    docs = read_table(spark, folder, "documents")
    profiles = language_id.learn_profiles(docs, language_id.ProfileSettings())
    return language_id.predict_languages(docs, profiles).select(
        "doc_id", (fold("doc_id") == 0).alias("held_out"), "lang_pred", "score")


def op6_vantage_points(spark, folder):
    return vantage_points.nearest(read_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_mixing(spark, folder):
    return mixing.mix(read_table(spark, folder, "documents"), mixing.MixTarget(max_repeats=1.25))


# The bisection is a recursive query; the running sums need no blocks here.
OP7_SQL = r"""
with recursive docs as (
    select doc_id, coalesce(source, '') as source,
        md5(concat_ws('|', '0', coalesce(doc_id::varchar, ''), md5(coalesce(text, '')))) as key,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as tokens
    from documents
), totals as (
    select source, sum(tokens)::bigint as total, sum(tokens) / (select sum(tokens) from docs) as share
    from docs group by source having sum(tokens) > 0
), steps as (
    select 0 as step, 0.0::double as low, case when r0 <= 1.25 then 0.0 else 1.0 end::double as high
    from (select max(1 / share) / count(*) as r0 from totals)
    union all
    select step + 1, case when ok then low else (low + high) / 2 end, case when ok then (low + high) / 2 else high end
    from (
        select step, low, high,
            max(pow(share, (low + high) / 2) / share) / sum(pow(share, (low + high) / 2)) <= 1.25 as ok
        from steps, totals where step < 30 group by step, low, high)
), exponent as (
    select high as a from steps where step = 30
), weighed as (
    select source, total, pow(share, a) / (select sum(pow(share, a)) from totals, exponent) as weight
    from totals, exponent
), planned as (
    select *, floor((select sum(total) from totals) * weight + 1e-6)::bigint as budget from weighed
), plan as (
    select *, budget // total as "full", budget % total as rest from planned
), placed as (
    select d.*, p.weight, p."full", p.rest,
        md5(concat_ws('|', d.source, "full"::varchar, key[1:3])) as k1,
        md5(concat_ws('|', d.source, "full"::varchar, key[1:3], key[4:6])) as k2
    from docs d left join plan p using (source)
), summed as (
    select *, sum(tokens) over (partition by source order by k1, k2, key
        range between unbounded preceding and current row) as upto from placed
), taken as (
    select *, case when "full" is null then 1 else "full" + (rest > 0 and k1 || k2 || key <= coalesce(ending, ''))::int end as n
    from summed left join (
        select source, max(k1 || k2 || key) as ending from summed where tokens > 0 and upto <= rest group by source
    ) using (source)
), passes as (
    select *, unnest(range(n::bigint))::int as epoch from taken
)
select doc_id, source, tokens as n_tokens, coalesce(weight, 0) as weight, epoch,
    md5(concat_ws('|', source, epoch::varchar, key[1:3]))[1:8] as block,
    md5(concat_ws('|', source, epoch::varchar, key[1:3], key[4:6]))[1:8] || key[1:16] as position
from passes
"""

def op8_packing(spark, folder):
    return packing.pack(read_table(spark, folder, "documents"))


def op9_rule_ensemble(spark, folder):
    docs = read_table(spark, folder, "documents")
    model = ensemble.learn_quality(docs, read_table(spark, folder, "labels"))
    return ensemble.score_quality(docs, model).select(
        "doc_id", (fold("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_page_text(spark, folder):
    return page_difference.main_text(read_table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op11_hyper_minhash(spark, folder):
    return hyper_minhash.near_duplicates(read_table(spark, folder, "documents"))


OP11_SQL = r"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') as w
    from documents
), sets as (
    select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) end as s
    from words
), sizes as (
    select doc_id, len(s)::bigint as n from sets
), grams as (
    select doc_id, unnest(s) as g from sets
), pairs as (
    select a.doc_id as a, b.doc_id as b, count(*) as c from grams a join grams b on a.g = b.g and a.doc_id <> b.doc_id
    group by all
), links as (
    select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)
), reach as (
    select a as doc_id, b as other from links
    union
    select r.doc_id, l.b from reach r join links l on l.a = r.other
), least as (
    select doc_id, min(other) as other from reach group by doc_id
)
select doc_id, n as n_shingles, least(doc_id, coalesce(other, doc_id)) as component_id,
    doc_id = least(doc_id, coalesce(other, doc_id)) as kept
from sizes left join least using (doc_id)
"""


def op12_filter_audit(spark, folder):
    return filter_audit.audit(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


# Documents are folded to their sets of failing filters; every order is then walked over these.
OP12_SQL = r"""
with words as (
    select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
    from documents
), failing as (
    select doc_id, part, (len(w) < 200)::int + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::int
        + 4 * (100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 2 * length(text))::int
        + 8 * regexp_matches(text, '[#$%&*|]')::int
        + 16 * coalesce(doc_id > min(doc_id) over (partition by text), false)::int as bits
    from words
), known as (
    select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id
), cells as (
    select part, bits, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
    from failing left join known using (doc_id) group by part, bits
), letters as (
    select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) t(l, bit)
), orders as (
    select a.l || b.l || c.l || d.l || e.l as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
    from letters a join letters b on b.l <> a.l join letters c on c.l not in (a.l, b.l)
    join letters d on d.l not in (a.l, b.l, c.l) join letters e on e.l not in (a.l, b.l, c.l, d.l)
), steps as (
    select filter_order, step, bits[step] as bit, coalesce(list_sum(bits[1 : step - 1]), 0)::int as before
    from orders, range(1, 6) t(step)
), sizes as (
    select part, bit, before, sum(n) filter (bits & (bit | before) = 0) as kept,
        sum(n) filter (bits & bit > 0 and bits & before = 0) as removed,
        sum(n) filter (bits & bit > 0 and bits & before > 0) as redundant,
        sum(n) filter (bits = bit) as unique_fails,
        sum(good) filter (bits & bit > 0 and bits & before = 0) as good_lost,
        sum(toxic) filter (bits & bit > 0 and bits & before = 0) as toxic_lost
    from cells, (select distinct bit, before from steps) group by part, bit, before
), whole as (
    select part, filter_order, step::int as step, s.bit, kept, removed, redundant, unique_fails, good_lost, toxic_lost
    from sizes join steps s using (bit, before)
)
select part, filter_order, step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed,
    coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails,
    coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
    coalesce(sum(removed) over (partition by part, bit), 0)::bigint as shapley
from whole
"""


def op13_max_sketches(spark, folder):
    return max_sketches.search(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


OP13_SQL = r"""
with words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w
    from documents
), totals as (
    select count(*) as documents, sum(len(w))::bigint as length from words where len(w) > 0
), counts as (
    select doc_id, n, w as term, count(*) as tf from (
        select doc_id, len(w) as n, unnest(w) as w from words) group by all
), wanted as (
    select distinct item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark
), weights as (
    select term, floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1)))::bigint as w
    from counts, totals group by term, documents
), scores as (
    select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * documents) // length))))::bigint as score
    from wanted join counts using (term) join weights using (term), totals group by item_id, doc_id
)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
from scores where score > 0 qualify rank <= 10
"""


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_suffix_levels": op2_suffix_levels,
    "op3_secret_scan": op3_secret_scan,
    "op4_simhash": op4_simhash,
    "op5_language_id": op5_language_id,
    "op6_vantage_points": op6_vantage_points,
    "op7_mixing": op7_mixing,
    "op8_packing": op8_packing,
    "op9_rule_ensemble": op9_rule_ensemble,
    "op10_page_text": op10_page_text,
    "op11_hyper_minhash": op11_hyper_minhash,
    "op12_filter_audit": op12_filter_audit,
    "op13_max_sketches": op13_max_sketches,
}

ORACLES = {
    "op1_quality_rules": OP1_SQL,
    "op7_mixing": OP7_SQL,
    "op11_hyper_minhash": OP11_SQL,
    "op12_filter_audit": OP12_SQL,
    "op13_max_sketches": OP13_SQL,
}
