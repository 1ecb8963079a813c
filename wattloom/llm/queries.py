"""The operators as queries over the test tables, with comparison SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wattloom.llm.checksums import crc32_sql
from wattloom.llm.common import table
from wattloom.llm.exact_dedup import exact_dedup_report
from wattloom.llm.hard_negatives import hard_negative_report
from wattloom.llm.line_dedup import line_report
from wattloom.llm.mixing import mixing_report
from wattloom.llm.packing import packing_report
from wattloom.llm.passages import repeated_passages
from wattloom.llm.quality_model import quality_scores
from wattloom.llm.quality_rules import quality_report
from wattloom.llm.resampling import importance_report
from wattloom.llm.sharding import shard_report
from wattloom.llm.simhash import near_duplicate_report
from wattloom.llm.token_files import token_file_report
from wattloom.llm.warc import warc_report


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup_report(table(spark, sf_dir, "documents"))


def op2_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_report(table(spark, sf_dir, "pages"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_report(table(spark, sf_dir, "documents"))


# Domains are the languages, as the documents listed in labels have them; the target weights are in tokens.
DOMAIN_WEIGHTS = {"en": 0.5, "de": 0.2, "fr": 0.15, "es": 0.15}


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled table: doc_id and domain of the documents listed in labels."""
    listed = labels.select("doc_id").where("doc_id is not null").distinct()
    return docs.select("doc_id", "lang").join(listed, "doc_id", "left_semi").withColumnRenamed("lang", "domain")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing_report(docs, labelled_domains(docs, table(spark, sf_dir, "labels")), DOMAIN_WEIGHTS)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_report(table(spark, sf_dir, "documents"))


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_report(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negative_report(table(spark, sf_dir, "embeddings"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_report(table(spark, sf_dir, "documents"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_quality_model": op2_quality_model,
    "op3_quality_rules": op3_quality_rules,
    "op4_line_dedup": op4_line_dedup,
    "op5_warc": op5_warc,
    "op6_simhash": op6_simhash,
    "op7_mixing": op7_mixing,
    "op8_packing": op8_packing,
    "op9_passages": op9_passages,
    "op10_token_files": op10_token_files,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_sharding": op12_sharding,
    "op13_resampling": op13_resampling,
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": r"""
        with signed as (
            select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents
        )
        select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = min(doc_id) over w as kept, text_sha256
        from signed window w as (partition by text_sha256)
    """,
    "op3_quality_rules": r"""
        with words as (
            select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
                string_split(coalesce(text, ''), chr(10)) as lines
            from documents
        ),
        windows as (
            select doc_id, i, w[i:i + 4] as five from words, unnest(generate_series(1, len(w) - 4)) as u(i) where len(w) >= 5
        ),
        repeats as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, five) as n from windows) where n > 1),
        covered as (select doc_id, count(distinct i + k) as n from repeats, unnest([0, 1, 2, 3, 4]) as u(k) group by doc_id),
        measured as (
            select words.doc_id, len(w)::bigint as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
                length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as n_symbols,
                len(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
                    - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) as n_dup_lines,
                coalesce(covered.n, 0) as n_repeat_words, len(lines) as n_lines
            from words left join covered on covered.doc_id = words.doc_id
        ),
        judged as (
            select *, (n_words < 10)::bigint + 2 * (100 * n_repeat_words > 20 * n_words)::bigint + 4 * (100 * n_symbols > 20 * n_words)::bigint
                + 8 * (100 * n_dup_lines > 50 * n_lines)::bigint + 16 * (word_chars < 2 * n_words)::bigint
                + 32 * (word_chars > 15 * n_words)::bigint as failed
            from measured
        )
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed % 4 > 0 as base_failed, failed = 0 as kept,
            n_lines, failed, rule as sole_rule, case when rule is not null then count(*) over (partition by rule) end as sole_rule_docs
        from judged left join (values (1, 'few_words'), (2, 'repeated_windows'), (4, 'many_symbols'), (8, 'repeated_lines'),
            (16, 'short_words'), (32, 'long_words')) as rules(bit, rule) on failed = bit
    """,
    "op4_line_dedup": r"""
        with lines as (
            select row, doc_id, pos, part,
                translate(regexp_replace(part, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
            from (select row_number() over () as row, doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents),
                unnest(parts) with ordinality as u(part, pos)
        ),
        frequent as (
            select key, max(doc_id) as last_doc from lines where length(key) >= 40 group by key having count(distinct row) >= 5
        ),
        marked as (
            select lines.*, frequent.key is not null and lines.doc_id is distinct from last_doc as gone
            from lines left join frequent on frequent.key = lines.key
        )
        select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
            sha256(coalesce(string_agg(part, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
        from marked group by row, doc_id
    """,
    "op5_warc": r"""
        with signed as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as h from pages),
        grouped as (select *, max(page_id) over (partition by h) as target from signed),
        coded as (
            select *, [('0x' || h[5 * g + 1 : 5 * g + 5])::integer for g in range(8)] as fives, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' as letters from grouped
        )
        select page_id, payload_bytes,
            array_to_string([letters[(v >> 15) + 1] || letters[((v >> 10) & 31) + 1] || letters[((v >> 5) & 31) + 1] || letters[(v & 31) + 1] for v in fives], '') as payload_digest,
            case when page_id < target then 'revisit' else 'response' end as record_type,
            case when page_id < target then target end as refers_to
        from coded
    """,
    "op11_hard_negatives": r"""
        with taken as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                list_transform(embedding, lambda x: floor(256 * x::double)) as vec
            from embeddings
            where vec_id is not null and label is not null and embedding is not null
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        scored as (
            select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_inner_product(a.vec, b.vec)::bigint as score
            from taken a join taken b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0
        ),
        positives as (
            select anchor_id, vec_id as positive_id, score as positive_score from scored where same
            qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
        ),
        ranked as (
            select p.*, vec_id as negative_id, score as negative_score,
                row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) as rank
            from positives p join scored s on p.anchor_id = s.anchor_id and not same
            where 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
        )
        select anchor_id, positive_id, rank::integer as rank, negative_id, positive_score, negative_score from ranked where rank <= 3
    """,
    "op12_sharding": f"""
        with signed as (
            select doc_id, coalesce('s' || source, 'n') as stratum, strlen(coalesce(text, '')) + 1 as size, {crc32_sql("coalesce(text, '')")} as text_crc32
            from documents
        ),
        keyed as (
            select *, sha256('12:' || coalesce(doc_id::varchar, '') || ':' || size || ':' || text_crc32) as key,
                ('0x' || substr(sha256(stratum), 1, 8))::bigint / 4294967296.0::double as shift
            from signed
        ),
        spread as (
            select *, (row_number() over (partition by stratum order by key) - 1 + shift) / count(*) over (partition by stratum) as fraction from keyed
        ),
        numbered as (
            select *, row_number() over (order by fraction, key) - 1 as position, count(*) over () as rows from spread
        )
        select doc_id, size, text_crc32, 'rows' as law, (position * 8 // rows)::integer as shard,
            position - (position * 8 // rows * rows + 7) // 8 as slot, null::integer as grown_shard
        from numbered
    """,
    "op13_resampling": rf"""
        with texts as (
            select true as target, item_id as doc_id, text from benchmark union all select false, doc_id, text from documents
        ),
        split as (
            select target, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
            from texts
        ),
        features as (
            select target, doc_id, w[i] as feature from split, unnest(generate_series(1, len(w))) as u(i)
            union all
            select target, doc_id, w[i] || ' ' || w[i + 1] from split, unnest(generate_series(1, len(w) - 1)) as u(i)
        ),
        hashed as (
            select feature, {crc32_sql("feature")} % 10000 as bucket from (select distinct feature from features)
        ),
        held as (select target, doc_id, bucket from features join hashed using (feature)),
        counts as (
            select bucket, count(*) filter (where not target) as s, count(*) filter (where target) as t from held group by bucket
        ),
        gains as (
            select bucket, floor(1000 * ln(((t + 1.0::double) * (sum(s) over () + 10000.0::double)) / ((s + 1.0::double) * (sum(t) over () + 10000.0::double)))) as gain
            from counts
        ),
        weights as (
            select doc_id, count(*) as n_features, floor(sum(gain) / count(*))::bigint as weight
            from held join gains using (bucket) where not target group by doc_id
        ),
        scored as (
            select doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
                coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296.0::double)))::bigint as score
            from split left join weights using (doc_id) where not target
        ),
        ranked as (
            select doc_id, row_number() over (order by score desc, doc_id) as rank, 25 * count(*) over () // 100 as drawn from scored where n_words >= 20
        )
        select scored.doc_id, n_features, weight, score, rank from scored left join ranked on scored.doc_id = ranked.doc_id and rank <= drawn
    """,
}
