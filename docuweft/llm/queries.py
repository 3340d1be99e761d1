"""One query per operator over its whole table, under the columns its contract names, and SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, centroids, compression, lines, packing, phrases, pii, quality_rules, resampling, sentencepiece_codec, simhash, urls, warc
from .common import table

#: Rows on which quality models may be trained; the others are held out.
TRAINED = "pmod(crc32(encode(cast(doc_id as string), 'UTF-8')), 4) <> 2"


#: Where the vocabulary files of public tokenizers are; a parameter of the operators.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, whether the two libraries agree on them, and whether the text comes back from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = sentencepiece_codec.encode_and_verify(docs, PIECE_BPE)
    return found.select("doc_id", "n_tokens", "ids_crc32", "agrees", "comes_back")


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", pii.find_pii(F.col("text")).alias("spans"))
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(spans, s -> s.base and s.kind = '{k}')) as long)").alias(f"n_{k}") for k in pii.BASE_KINDS],
        F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"),
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs, min_docs=10, min_chars=1).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256")
    )


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge_quality(docs, quality_rules.train(docs, table(spark, sf_dir, "labels"))).drop("text")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), WORD_BPE)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = compression.train(docs, table(spark, sf_dir, "labels"), where=TRAINED)
    scored = compression.score_quality(docs, model)
    return scored.select("doc_id", F.expr(f"not ({TRAINED})").alias("held_out"), "score", "predicted")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = resampling.resample(docs, table(spark, sf_dir, "benchmark").select("text"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.neighbours_compared(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.with_inertia(*centroids.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")))


QUERIES = {
    f.__name__: f for f in (
        op1_sentencepiece, op2_nearest, op3_pii, op4_simhash, op5_line_dedup, op6_url_filters, op7_quality_rules, op8_packing, op9_warc,
        op10_quality_classifier, op11_resampling, op12_fingerprints, op13_clustering,
    )
}

_BLANK = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

def _clustering_sql(clusters: int = 8, rounds: int = 10) -> str:
    """Rounds one after the other: a_i is the assignment to the centroids c_i, c_(i+1) what it moves them to."""
    steps = [f"""
        whole as materialized (
            select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * x::double) as bigint)) as comps from embeddings
            where len(embedding) = 64 and len(list_filter(embedding, lambda x: isfinite(x::double))) = 64
        ), c0 as materialized (
            select row_number() over (order by h) - 1 as k, comps
            from (select comps, sha256('3:' || vec_id) as h from whole order by h limit {clusters})
        )"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} as materialized (
            select vec_id, comps, k, cast(list_sum(list_transform(list_zip(comps, goal), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as bigint) as d
            from (select w.*, c.k, c.comps as goal from whole w cross join c{i} c)
            qualify row_number() over (partition by vec_id order by d, k) = 1
        )""")
        if i < rounds:
            steps.append(f"""m{i} as materialized (
                select k, list(cast((s - ((s % n) + n) % n) / n as bigint) order by pos) as comps
                from (select k, pos, sum(v) as s, count(*) as n from (
                    select k, unnest(comps) as v, generate_subscripts(comps, 1) as pos from a{i}) group by k, pos)
                group by k
            ), c{i + 1} as materialized (select c.k, coalesce(m.comps, c.comps) as comps from c{i} c left join m{i} m on c.k = m.k)""")
    return f"""with {", ".join(steps)}
        select a.vec_id, cast(a.k as int) as cluster, a.d as distance, cast(sum(d) over (partition by a.k) as bigint) as cluster_inertia,
               cast(sum(d) over () as bigint) as inertia, sha256(array_to_string(c.comps, ',')) as centroid_sha256
        from a{rounds} a join c{rounds} c on a.k = c.k"""


def _crc32_sql(data: str) -> str:
    """crc32 of a blob by its standard table, which follows from the polynomial."""
    entries = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        entries.append(n)
    read = f"list_transform(range(1, octet_length({data}) + 1), lambda i: cast('0x' || substr(hex({data}), 2 * i - 1, 2) as bigint))"
    step = f"lambda c, b: xor(c >> 8, {entries}[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {read}), {step}), 4294967295)"


_RESAMPLING = f"""
        with texts as (
            select 0 as kind, doc_id as id, text from documents union all select 1, item_id, text from benchmark
        ), worded as (
            select kind, id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from texts
        ), listed as (
            select kind, id, len(w) as n_words,
                   unnest(w || list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1])) as feature from worded
        ), hashed as materialized (
            select feature, {_crc32_sql("encode(feature)")} % 10000 as bucket from (select distinct feature from listed)
        ), counted as (
            select bucket, count(*) filter (kind = 0) as s, count(*) filter (kind = 1) as t from listed join hashed using (feature) group by bucket
        ), gained as (
            select bucket, cast(floor(1000 * ln((t + 1)::double * ((select sum(s) from counted) + 10000)
                   / ((s + 1)::double * ((select sum(t) from counted) + 10000)))) as bigint) as gain from counted
        ), weighed as (
            select id, count(*) as n, sum(gain) as total from listed join hashed using (feature) join gained using (bucket) where kind = 0 group by id
        ), scored as (
            select id as doc_id, len(w) as n_words, coalesce(n, 0) as n_features,
                   cast(coalesce((total - ((total % n) + n) % n) / n, 0) as bigint) as weight,
                   cast('0x' || substr(sha256('7:' || id), 1, 8) as bigint) as h
            from worded left join weighed using (id) where kind = 0
        ), noisy as (
            select *, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296))) as bigint) as score from scored
        ), placed as (
            select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as n from noisy where n_words >= 20
        )
        select doc_id, n_features, weight, score, case when place <= 25 * n // 100 then place end as rank
        from noisy left join placed using (doc_id)"""

ORACLE = {
    "op5_line_dedup": f"""
        with lines as (
            select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
            from documents
        ), keyed as (select *, {_LOWER.format(f"trim(line, {_BLANK})")} as key from lines),
        frequent as (select key from keyed where length(key) >= 1 group by key having count(distinct doc_id) >= 10)
        select doc_id, count(*) as n_lines, count(*) filter (f.key is not null) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by pos) filter (f.key is null), '')) as kept_sha256
        from keyed k left join frequent f on k.key = f.key
        group by doc_id""",
    "op6_url_filters": f"""
        with cut as (
            select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
        ), parts as (
            select page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*', 0)")} as host,
                   substr(rest, length(regexp_extract(rest, '^[^/?#]*', 0)) + 1) as tail from cut
        ), whole as (select *, regexp_extract(tail, '^[^?#]*', 0) as path from parts),
        judged as (
            select page_id, host, path,
                case
                    when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
                    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
                    when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
                    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/'
                end as rule,
                case
                    when starts_with(host, 'docs.') or host like '%.docs.%' then '||docs.'
                    else (select max(p) from (values
                        ('-pills.', contains(host || tail, '-pills.')),
                        ('||casino.', regexp_matches(host || tail, '^([^/?#]*[.])?casino[.]')),
                        ('.casino.', contains(host || tail, '.casino.')), ('/casino/', contains(host || tail, '/casino/')),
                        ('||xxx.', regexp_matches(host || tail, '^([^/?#]*[.])?xxx[.]')),
                        ('.xxx.', contains(host || tail, '.xxx.')), ('-porn.', contains(host || tail, '-porn.')),
                        ('/porn/', contains(host || tail, '/porn/')),
                        ('||ads.', regexp_matches(host || tail, '^([^/?#]*[.])?ads[.]')),
                        ('||tracker.', regexp_matches(host || tail, '^([^/?#]*[.])?tracker[.]')),
                        ('/affiliate/*/click', regexp_matches(host || tail, '(?s)/affiliate/.*/click'))) v(p, fits) where fits)
                end as found
            from whole
        )
        select page_id, host, path, rule,
               case when rule in ('net/', 'example.com/de/') then 'block' when rule is not null then 'allow'
                    when found is null or found = '||docs.' then 'allow' else 'block' end as verdict,
               case when rule is null then found end as pattern
        from judged""",
    "op9_warc": """
        with sized as (select page_id, sha1(coalesce(html, '')) as payload_digest, octet_length(encode(coalesce(html, ''))) as payload_bytes from pages),
        last as (select payload_digest, max(page_id) as page_id from sized where payload_bytes >= 1000 group by all having count(*) > 1)
        select s.page_id, s.payload_bytes, s.payload_digest,
               case when l.page_id <> s.page_id then 'revisit' else 'response' end as record_type,
               case when l.page_id <> s.page_id then l.page_id end as refers_to
        from sized s left join last l on s.payload_digest = l.payload_digest""",
    "op11_resampling": _RESAMPLING,
    "op13_clustering": _clustering_sql(),
}
