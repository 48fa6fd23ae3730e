"""The registered queries of the operators, one per operator over its whole table, and their SQL."""

from __future__ import annotations

import uuid
import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from outledger.llm import (
    decontamination, hard_negatives, language, licenses, mixing, near_duplicates, quality, runs, token_counts,
    token_file, topk, toxicity, warc,
)
from outledger.llm.frames import crc_fold, ship_package, table
from outledger.runtime import checkpoint_dir

BYTE_VOCABULARY, WORD_VOCABULARY = "byte_bpe_50k.json", "word_bpe_49k.json"


def output_folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    seen = crc_fold("doc_id", 5) != 0
    model = toxicity.fit(docs.filter(seen), table(spark, sf_dir, "labels").filter(seen))
    return toxicity.score(docs, model).select(
        "doc_id", (crc_fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted"
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_VOCABULARY))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op5_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return token_file.token_table(
        table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY), output_folder(spark, "tokens")
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    read = warc.archive_round_trip(table(spark, sf_dir, "pages"), output_folder(spark, "archive"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"), licenses.known_digests(spark))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    languages, weights = language.fit(docs.filter(crc_fold("doc_id", 3) != 1))
    return language.identify(docs, languages, weights).select(
        "doc_id", (crc_fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score"
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    seen = crc_fold("doc_id", 4) != 2
    model = quality.fit(docs.filter(seen), table(spark, sf_dir, "labels").filter(seen))
    return quality.score(docs, model).select(
        "doc_id", (crc_fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted"
    )


def periodic(doc_id: int | None, words: list[str]) -> list[str]:
    """Every tenth document (by crc32 of its id) goes on with a repeated stretch from a word on."""
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 or not n or doc_id is None:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return runs.periodic_runs(table(spark, sf_dir, "documents"), words=periodic, texts=False)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    vectors = table(spark, sf_dir, "embeddings")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.withColumn("label", noisy)
    return hard_negatives.hard_negatives(rows, rows.filter("vec_id % 100 = 0"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_token_counts, op3_decontamination, op4_near_duplicates, op5_token_file, op6_warc,
        op7_top_k, op8_licenses, op9_language, op10_mixing, op11_quality, op12_runs, op13_hard_negatives,
    )
}

# ---------------------------------------------------------------- SQL

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op3_decontamination": rf"""
with bench as (
    select item_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark where text is not null),
starts as (select item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) as i from bench where len(w) > 0),
patterns as (select distinct item_id, array_to_string(w[i : i + 9], ' ') as pattern, least(10, len(w)) as n from starts),
docs as (
    select doc_id, coalesce(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
    from documents),
places as (
    select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
    from docs, (select distinct n from patterns) where len(w) >= n),
found as (
    select doc_id, i, p.n, item_id from
        (select doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') as pattern from places) d
    join patterns p on d.pattern = p.pattern and d.n = p.n),
hit as (
    select doc_id, count(distinct word) as n_hit
    from (select doc_id, unnest(range(i, i + n)) as word from found) group by doc_id),
items as (
    select doc_id, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256
    from (select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
    cast(coalesce(n_items, 0) as bigint) as n_items, coalesce(items_sha256, sha256('')) as items_sha256,
    coalesce(n_hit, 0) > 0 as contaminated
from docs d left join hit using (doc_id) left join items using (doc_id)""",
    "op4_near_duplicates": rf"""
with recursive words as (
    select doc_id, coalesce(regexp_extract_all({_LOWER.format("text")}, '[^\x20\x09-\x0D]+'), []) as w from documents),
shingles as (
    select distinct doc_id, array_to_string(w[i : i + 4], ' ') as s from
        (select doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) as i from words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (
    select x.doc_id as a, y.doc_id as b, count(*) as common
    from shingles x join shingles y on x.s = y.s and x.doc_id <> y.doc_id group by all),
links as (
    select a, b from pairs join sizes p on a = p.doc_id join sizes q on b = q.doc_id
    where 100 * common >= 75 * (p.n + q.n - common)),
reach as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
lowest as (select a, min(b) as b from reach group by a)
select doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, least(doc_id, coalesce(b, doc_id)) as component_id,
    doc_id <= coalesce(b, doc_id) as kept
from words left join sizes using (doc_id) left join lowest on doc_id = a""",
    "op6_warc": """
with sized as (
    select page_id, coalesce(html, '') as html, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes from pages),
hashed as (select page_id, payload_bytes, sha256(html) as payload_digest from sized),
firsts as (
    select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) else page_id end as f
    from hashed)
select page_id, payload_bytes, payload_digest, case when f = page_id then 'response' else 'revisit' end as record_type,
    case when f <> page_id then f end as refers_to from firsts""",
    "op7_top_k": """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
    from embeddings where embedding is not null and vec_id is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.e, c.e) as bigint) as score
    from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 5""",
    "op10_mixing": r"""
with docs as (
    select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
        (cast(cast('0x' || left(md5(cast(doc_id as varchar)), 12) as bigint) as double) + 0.5) / 281474976710656.0 as u,
        md5(coalesce(text, '')) as tie
    from documents),
sources as (
    select source, cast(sum(size) as bigint) as source_size,
        [5.0, 2.0, 1.0][(row_number() over (order by source nulls last) - 1) % 3 + 1]::double as weight
    from docs group by source),
ranked as (select *, 2.0::double * source_size as cap, 2.0::double * source_size / weight as ratio from sources),
levels as (
    select *, row_number() over o as place,
        (1.5::double * sum(source_size) over () - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0))
        / (sum(weight) over () - coalesce(sum(weight) over (o rows between unbounded preceding and 1 preceding), 0)) as level
    from ranked window o as (order by ratio, source nulls last)),
water as (select min_by(level, place) as level from levels where level <= ratio),
targets as (
    select source, source_size, least(cap, coalesce(w.level, ratio) * weight) as target
    from levels, water w),
filled as (
    select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as copies from targets),
placed as (
    select d.*, source_size, target, copies, target - copies * source_size as missing,
        u / (1 - u) / nullif(size, 0) as odds
    from docs d join filled f on d.source is not distinct from f.source),
summed as (
    select *, coalesce(sum(size) over (partition by source order by odds nulls last, tie, cast(doc_id as varchar)
        rows between unbounded preceding and 1 preceding), 0) as earlier
    from placed)
select doc_id, size, source_size, target,
    cast(size * (copies + case when size > 0 and earlier + size / 2.0::double <= missing then 1 else 0 end) as bigint) as taken
from summed""",
    "op13_hard_negatives": """
with v as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
    from embeddings where embedding is not null and vec_id is not null and label is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, cast(list_dot_product(a.e, c.e) as bigint) as score
    from v a join v c on a.vec_id <> c.vec_id where a.vec_id % 100 = 0),
positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
ranked as (
    select anchor_id, positive_id, vec_id as negative_id, positive_score, score as negative_score,
        row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as rank
    from positives join scored using (anchor_id)
    where not same and 80 * positive_score <= 100 * score and score <= positive_score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score
from ranked where rank <= 5""",
}
