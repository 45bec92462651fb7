"""Queries on texts: normal forms, keys, shingles, signatures, similarity, groups of duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewrack.functions import text as T
from tidewrack.operators import textdedup as D
from tidewrack.session import stored, table, widened

K, BANDS, WIDTH = 8, 4, 2


def docs(spark, sf):
    return table(spark, sf, "documents")


def manifest(spark, sf):
    return table(spark, sf, "manifest")


def _sets(spark, sf):
    return D.shingle_sets(docs(spark, sf), "doc_id", "text")


def _signatures(spark, sf):
    return D.minhash(_sets(spark, sf), K)


def normalize_key(spark, sf):
    return manifest(spark, sf).select("line_no", T.sample_key(F.col("cut_id")).alias("cut_key"), T.file_key(F.col("tar_path")).alias("tar_key"), T.record_id(F.concat(F.lit("./"), "cut_id")).alias("record_id"), T.base_language(F.col("language")).alias("lang"))


def normalized_text(spark, sf):
    m = widened(manifest(spark, sf).select("line_no", "text", "language"))
    return m.select("line_no", T.normalize_text(F.col("text"), F.col("language")).alias("key"), T.normalize_text(F.col("text"), F.col("language"), True).alias("bare_key"))


def min_length_filter(spark, sf):
    return manifest(spark, sf).where(F.length("normalized_text") >= 12).select("line_no", "dataset", "cut_id")


def lang_preset_filter(spark, sf):
    lang = T.base_language(F.col("language"))
    return manifest(spark, sf).select("line_no", *[T.allowed_language(lang, p).alias(p) for p in T.LANGUAGE_PRESETS])


def tagged_text(spark, sf):
    spoken = F.concat(F.regexp_replace("text", "[.]", " <PERIOD>"), F.when(F.col("line_no") % 7 == 0, F.lit(" <NOISE>")).otherwise(F.lit("")))
    return manifest(spark, sf).select("line_no", F.length(T.clean_tagged(spoken)).alias("n"))


def repetition_flag(spark, sf):
    return docs(spark, sf).select("doc_id", T.excess_repetition(T.words(F.col("text")), 2, 3).alias("repeats"))


def rewrite_guard(spark, sf):
    m = manifest(spark, sf).where("text is not null")
    return m.select("line_no", T.valid_rewrite(F.col("text"), F.coalesce("normalized_text", F.lit(""))).alias("text"))


def word_shingles(spark, sf):
    return _sets(spark, sf).select("id", F.size("shingles").alias("n"), F.md5(F.array_join("shingles", "|")).alias("content"))


def char_shingles(spark, sf):
    return manifest(spark, sf).select("line_no", F.size(T.char_shingles(F.coalesce("normalized_text", F.lit("")), 12)).alias("n"))


def minhash_signature(spark, sf):
    return _signatures(spark, sf).select("id", F.array_join(F.col("signature").cast("array<string>"), ",").alias("signature"))


def lsh_buckets(spark, sf):
    return D.buckets(_signatures(spark, sf), BANDS, WIDTH)


def lsh_candidates(spark, sf):
    return D.candidates(D.buckets(D.signature_classes(stored(_signatures(spark, sf), "signatures"))[0], BANDS, WIDTH))


def signature_classes(spark, sf):
    return D.signature_classes(stored(_signatures(spark, sf), "signatures"))[1]


def consecutive_pairs(spark, sf):
    return D.chained(D.buckets(_signatures(spark, sf), BANDS, WIDTH))


def minhash_estimate(spark, sf):
    s = stored(_signatures(spark, sf), "signatures")
    return D.estimated(D.candidates(D.buckets(D.signature_classes(s)[0], BANDS, WIDTH)), s, K)


def word_jaccard_pairs(spark, sf):
    """Of all distinct deliveries; documents hold hardly any near pair."""
    reps, _ = D.distinct_sets(D.shingle_sets(manifest(spark, sf), "line_no", "normalized_text"))
    return D.similar_pairs(reps).withColumn("score", F.round("score", 6))


def word_jaccard_half(spark, sf):
    """As `word_jaccard_pairs` at the lower similarity of 0.5."""
    reps, _ = D.distinct_sets(D.shingle_sets(manifest(spark, sf), "line_no", "normalized_text"))
    return D.similar_pairs(reps, 0.5).withColumn("score", F.round("score", 6))


def delivery_clusters(spark, sf):
    return D.lsh_clusters(manifest(spark, sf), "line_no", "normalized_text")


def char_minhash(spark, sf):
    reps, _ = D.distinct_sets(D.char_sets(manifest(spark, sf), "line_no", "normalized_text"))
    return D.minhash(reps, K).select("id", F.array_join(F.col("signature").cast("array<string>"), ",").alias("signature"))


def char_clusters(spark, sf):
    return D.char_clusters(manifest(spark, sf), "line_no", "normalized_text")


def containment_clusters(spark, sf):
    return D.containment_clusters(manifest(spark, sf).withColumn("t", F.lower("normalized_text")), "line_no", "t")


def word_containment_pairs(spark, sf):
    return D.contained_pairs(_sets(spark, sf), 0.8, 3).withColumn("score", F.round("score", 6))


def duplicate_classes(spark, sf):
    return D.duplicate_classes(docs(spark, sf), "doc_id", "text")


def text_clusters(spark, sf):
    return D.lsh_clusters(docs(spark, sf), "doc_id", "text", max_fraction=0.9)


def frequent_text_cap(spark, sf):
    return D.frequent_texts(manifest(spark, sf), "text", 5)


def frequent_cap_report(spark, sf):
    return D.cap_report(manifest(spark, sf), "text", [1, 2, 5])


def new_against_baseline(spark, sf):
    """Records that today's match edges name and the older clusters do not."""
    e = table(spark, sf, "match_edges")
    new = e.select(F.col("src_dataset").alias("dataset"), F.col("src_cut_id").alias("cut_id")).union(e.select("dst_dataset", "dst_cut_id"))
    return new.subtract(table(spark, sf, "clusters").select("dataset", "cut_id"))


def chaining_diagnosis(spark, sf):
    c = table(spark, sf, "clusters").where("text_cluster_id is not null")
    sizes = c.select("text_cluster_id", "dataset", "cut_id").distinct().groupBy("text_cluster_id").agg(F.count(F.lit(1)).alias("cluster_size"))
    return D.chaining_diagnosis(sizes.select("cluster_size"), table(spark, sf, "match_edges").where("match_kind = 'text'"))


_WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\r]+'), lambda w: w <> '')"
_SHINGLES = f"""(select doc_id as id, list_sort(list_distinct(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
 when len(w) > 0 then [array_to_string(w, ' ')] else [] end)) as sh from (select doc_id, {_WORDS} as w from documents) where len(w) > 0)"""
_HASH = f"(select id, (('0x' || substr(md5(s), 1, 15))::bigint) % {D.PRIME} as h from (select id, unnest(sh) as s from {_SHINGLES}))"
_SIG = f"(select id, [{', '.join(f'min((h * {a} + {b}) % {D.PRIME})' for a, b in D.permutations(K))}] as sig from {_HASH} group by id)"
_BUCKETS = f"(select id, b.band as band, md5(array_to_string(b.s, ',')) as bucket from (select id, unnest([{', '.join(f'''{{'band': {i}, 's': sig[{i * WIDTH + 1}:{(i + 1) * WIDTH}]}}''' for i in range(BANDS))}]) as b from {_SIG}))"
_SAME = f"(select id, min(id) over (partition by sig) as rep from {_SIG})"
_PAIRS = f"""(with m as materialized (select b.* from {_BUCKETS} b join {_SAME} s using (id) where s.id = s.rep) select distinct x.id as a, y.id as b from m x join m y on x.band = y.band and x.bucket = y.bucket and x.id < y.id)"""
_TEXT = "(select line_no as doc_id, normalized_text as text from manifest)"
_LINES = _SHINGLES.replace("from documents)", f"from {_TEXT})")
_LINE_REPS = f"(select min(id) as id, any_value(sh) as sh from {_LINES} group by md5(array_to_string(sh, chr(10))))"
_TOKENS = _LINES.replace(_WORDS, "regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]+')").replace("\\\\", "\\")
_CHARS = """(select line_no as id, list_sort(list_distinct(case when length(normalized_text) >= 12 then list_transform(range(1, length(normalized_text) - 10), lambda i: substr(normalized_text, i, 12))
 else [rpad(normalized_text, 12, chr(0))] end)) as sh from manifest where normalized_text <> '')"""
_REPS = f"(select min(id) as id, any_value(sh) as sh from {_SHINGLES} group by md5(array_to_string(sh, chr(10))))"
_JACCARD = """(with t as materialized (select id, len(sh) as n, unnest(sh) as s from {sets}) select x.id as a, y.id as b, count(*) as shared, count(*) / (any_value(x.n) + any_value(y.n) - count(*)) as score
 from t x join t y on x.s = y.s and x.id < y.id group by x.id, y.id having count(*) >= 0.8 * (any_value(x.n) + any_value(y.n) - count(*)))"""
_GROUPED = """with recursive sets as materialized (select *, min(id) over (partition by md5(array_to_string(sh, chr(10)))) as rep from {sets}), e0 as materialized ({edges} union all select rep, id from sets where rep <> id),
 e as (select a, b from e0 union select b, a from e0), r as (select a, a as b from e union select r.a, e.b from r join e on r.b = e.a), c as (select a as id, min(b) as root from r group by a)
 select id, dense_rank() over (order by root) - 1 as cluster_id, count(*) over (partition by root) as cluster_size from c"""
_SIMILAR = """select a, b from (with t as materialized (select id, len(sh) as n, unnest(sh) as s from sets where id = rep) select x.id as a, y.id as b from t x join t y on x.s = y.s and x.id < y.id group by x.id, y.id having {test})"""


def _signed(sets, k):
    hashes = f"(select id, (('0x' || substr(md5(s), 1, 15))::bigint) % {D.PRIME} as h from (select id, unnest(sh) as s from {sets}))"
    return f"(select id, [{', '.join(f'min((h * {a} + {b}) % {D.PRIME})' for a, b in D.permutations(k))}] as sig from {hashes} group by id)"


_SIGNS = "t"
for _tag, _sign in T.TAG_SIGNS.items():
    _SIGNS = f"replace({_SIGNS}, '{_tag}', '{_sign}')"
_CHAR_REPS = f"(select min(id) as id, any_value(sh) as sh from {_CHARS} group by md5(array_to_string(sh, chr(10))))"
_CHAR_MET = f"""select a, b from (with m as materialized (select id, b.band as band, b.s as s from (select id, unnest([{', '.join(f"{{'band': {i}, 's': sig[{2 * i + 1}:{2 * i + 2}]}}" for i in range(16))}]) as b from {_signed(_CHAR_REPS, 32)})),
 p as (select distinct x.id as a, y.id as b from m x join m y on x.band = y.band and x.s = y.s and x.id < y.id)
 select a, b from p join sets x on x.id = a join sets y on y.id = b where len(list_intersect(x.sh, y.sh)) >= 0.5 * (len(x.sh) + len(y.sh) - len(list_intersect(x.sh, y.sh))))"""
_PRESET = ", ".join(
    f"coalesce({'l <> ' + repr('nospeech') if v is None else 'l in (' + ', '.join(map(repr, v)) + ')'}, false) as {k}" for k, v in T.LANGUAGE_PRESETS.items()
)

QUERIES = {f.__name__: f for f in (
    normalize_key, normalized_text, min_length_filter, lang_preset_filter, tagged_text, repetition_flag, rewrite_guard, word_shingles, char_shingles, minhash_signature,
    lsh_buckets, lsh_candidates, signature_classes, consecutive_pairs, minhash_estimate, word_jaccard_pairs, word_jaccard_half, delivery_clusters, char_minhash, char_clusters, containment_clusters, word_containment_pairs, duplicate_classes, text_clusters, frequent_text_cap,
    frequent_cap_report, new_against_baseline, chaining_diagnosis)}

SQL = {
    "normalize_key": r"""select line_no, lower(trim(cut_id)) as cut_key, lower(trim(regexp_replace(regexp_replace(tar_path, '^/data/', ''), '([^/.])\.[^./]*$', '\1'))) as tar_key, cut_id as record_id,
 lower(split_part(language, '-', 1)) as lang from manifest""",
    "min_length_filter": "select line_no, dataset, cut_id from manifest where length(normalized_text) >= 12",
    "lang_preset_filter": f"select line_no, {_PRESET} from (select line_no, lower(split_part(language, '-', 1)) as l from manifest)",
    "rewrite_guard": """select line_no, case when trim(n) <> '' and length(n) / greatest(length(text), 1) between 0.5 and 2.0 and not contains(n, 'Input:') and not contains(n, 'Output:') then n else text end as text
 from (select line_no, text, coalesce(normalized_text, '') as n from manifest where text is not null)""",
    "repetition_flag": f"""select d.doc_id, coalesce(r.m >= 3, false) as repeats from documents d left join (select doc_id, max(c) as m from (select doc_id, g, count(*) as c from
 (select doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i+1])) as g from (select doc_id, {_WORDS} as w from documents)) group by all) group by 1) r using (doc_id)""",
    "word_shingles": f"select id, len(sh) as n, md5(array_to_string(sh, '|')) as content from {_SHINGLES}",
    "minhash_signature": f"select id, array_to_string(sig, ',') as signature from {_SIG}",
    "lsh_buckets": f"select band, bucket, id from {_BUCKETS}",
    "lsh_candidates": f"select a, b from {_PAIRS}",
    "consecutive_pairs": f"select band, a, b from (select band, lag(id) over (partition by band, bucket order by id) as a, id as b from {_BUCKETS}) where a is not null",
    "minhash_estimate": f"""select a, b, len(list_filter(list_zip(x.sig, y.sig), lambda z: z[1] = z[2])) / {K} as estimate from {_PAIRS} p join {_SIG} x on p.a = x.id join {_SIG} y on p.b = y.id""",
    "word_jaccard_pairs": f"select a, b, shared, round(score, 6) as score from {_JACCARD.format(sets=_LINE_REPS)}",
    "word_jaccard_half": f"select a, b, shared, round(score, 6) as score from {_JACCARD.format(sets=_LINE_REPS).replace('0.8', '0.5')}",
    "word_containment_pairs": f"""with t as materialized (select id, len(sh) as n, unnest(sh) as s from {_SHINGLES}) select x.id as a, y.id as b, count(*) as shared, round(count(*) / least(any_value(x.n), any_value(y.n)), 6) as score
 from t x join t y on x.s = y.s and x.id < y.id group by x.id, y.id having count(*) >= 3 and count(*) / least(any_value(x.n), any_value(y.n)) >= 0.8""",
    "signature_classes": f"select id, rep from {_SAME}",
    "text_clusters": _GROUPED.format(sets=_SHINGLES, edges=_SIMILAR.format(test="count(*) >= 0.8 * (any_value(x.n) + any_value(y.n) - count(*))")),
    "delivery_clusters": _GROUPED.format(sets=_LINES, edges=_SIMILAR.format(test="count(*) >= 0.8 * (any_value(x.n) + any_value(y.n) - count(*))")),
    "char_minhash": f"select id, array_to_string(sig, ',') as signature from {_signed(_CHAR_REPS, K)}",
    "char_clusters": _GROUPED.format(sets=_CHARS, edges=_CHAR_MET),
    "containment_clusters": _GROUPED.format(sets=_TOKENS, edges=_SIMILAR.format(test="count(*) >= 3 and count(*) >= 0.8 * least(any_value(x.n), any_value(y.n))")),
    "tagged_text": f"""select line_no, case when t <> '' and not ({' or '.join(f"contains(t, '{tag}')" for tag in T.NON_SPEECH_TAGS)}) then length(lower(regexp_replace(replace({_SIGNS}, 'İ', 'i̇'), '\\s+([.,?!])', '\\1', 'g'))) end as n
 from (select line_no, trim(regexp_replace(text, '[.]', ' <PERIOD>', 'g') || case when line_no % 7 = 0 then ' <NOISE>' else '' end, ' ') as t from manifest)""",
    "char_shingles": f"select line_no, coalesce(len(sh), 0) as n from manifest m left join {_CHARS} c on c.id = m.line_no",
    "duplicate_classes": f"""with recursive p as materialized (select a, b from {_JACCARD.format(sets=_SHINGLES)}), e as (select a, b from p union all select b, a from p), r as (select id as a, id as b from {_SHINGLES} union select r.a, e.b from r join e on r.b = e.a),
 c as (select a as id, min(b) as class_id from r group by a) select id, class_id, count(*) over (partition by class_id) as class_size, (select count(*) from e where e.a = c.id) as links from c""",
    "frequent_text_cap": "select text, count(*) as n, count(*) - 5 as over from manifest where text is not null group by text having count(*) > 5",
    "frequent_cap_report": """select cap, count(*) filter (n > cap) as texts_over, sum(greatest(n - cap, 0))::bigint as rows_over from (select text, count(*) as n from manifest where text is not null group by 1),
 (values (1), (2), (5)) v(cap) group by cap""",
    "new_against_baseline": """select src_dataset as dataset, src_cut_id as cut_id from match_edges union select dst_dataset, dst_cut_id from match_edges except select dataset, cut_id from clusters""",
    "chaining_diagnosis": """with s as (select count(distinct (dataset, cut_id)) as z from clusters where text_cluster_id is not null group by text_cluster_id), l as (select list_sort(list(z)) as l, count(*) as n from s)
 select n as clusters, l[n] as largest, l[least(floor(n * 0.5), n - 1)::bigint + 1] as p50, l[least(floor(n * 0.9), n - 1)::bigint + 1] as p90, l[least(floor(n * 0.99), n - 1)::bigint + 1] as p99,
 (select coalesce(sum(z) filter (z > 10), 0)::bigint from s) as rows_above_10, (select coalesce(sum(z) filter (z > 50), 0)::bigint from s) as rows_above_50, (select coalesce(sum(z) filter (z > 100), 0)::bigint from s) as rows_above_100,
 (select coalesce(sum(z) filter (z > 1000), 0)::bigint from s) as rows_above_1000, (select sum(z * (z - 1) / 2) from s) as full_edges, (select count(*) from match_edges where match_kind = 'text') as edges,
 round((select count(*) from match_edges where match_kind = 'text') / (select sum(z * (z - 1) / 2) from s), 6) as density from l""",
}
