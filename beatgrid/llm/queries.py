"""The registered queries of this package over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatgrid.llm import (
    block_search,
    fill_middle,
    kneser_ney,
    line_dedup,
    lm_scoring,
    packing,
    pii,
    resampling,
    token_counts,
    token_files,
    vertical_join,
    warc,
    wu_manber,
)
from beatgrid.llm.common import table


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"))


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vertical_join.join_documents(table(spark, sf_dir, "documents"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wu_manber.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), whole=True)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.transform(table(spark, sf_dir, "documents"), output=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_language_model": op2_language_model,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_personal_data": op6_personal_data,
    "op7_token_counts": op7_token_counts,
    "op8_decontamination": op8_decontamination,
    "op9_quality": op9_quality,
    "op10_warc": op10_warc,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_line_dedup": op12_line_dedup,
    "op13_fill_in_middle": op13_fill_in_middle,
}

#: SQL of the same results, where SQL can express them.
ORACLE: dict[str, str] = {
    "op4_nearest_neighbours": """
        with v as (
            select vec_id, embedding::double[] as e from embeddings
            where vec_id is not null and embedding is not null and len(embedding) > 0
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
                and len(list_filter(embedding, lambda x: x <> 0)) > 0),
        pairs as (
            select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e) as score
            from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id and len(c.e) = len(q.e))
        select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::integer as rank, vec_id, score
        from pairs qualify rank <= 20
    """,
    "op8_decontamination": r"""
        with d as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
        b as (
            select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark where item_id is not null),
        p as (
            select distinct item_id, least(len(w), 10) as n, array_to_string(w[k : k + least(len(w), 10) - 1], ' ') as run
            from (select *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as k from b where len(w) > 0)),
        sizes as (select distinct n from p),
        found as (
            select o.doc_id, o.k, o.n, p.item_id
            from (
                select doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') as run
                from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as k from d, sizes where len(w) >= n)) o
            join p on p.n = o.n and p.run = o.run),
        hit as (
            select doc_id, count(distinct place) as n_hit
            from (select doc_id, unnest(range(k, k + n)) as place from found) group by doc_id),
        named as (
            select doc_id, count(*) as n_items, string_agg(i, ',' order by i) as items
            from (select distinct doc_id, item_id::varchar as i from found) group by doc_id)
        select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
            sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from d left join hit using (doc_id) left join named using (doc_id)
    """,
    "op10_warc": """
        with p as (
            select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
        k as (select payload_digest, max(page_id) as keep from p where payload_bytes >= 1000 group by payload_digest)
        select p.page_id, payload_bytes, p.payload_digest,
            case when keep <> p.page_id then 'revisit' else 'response' end as record_type,
            case when keep <> p.page_id then keep end as refers_to
        from p left join k on p.payload_digest = k.payload_digest and p.payload_bytes >= 1000
    """,
    "op11_importance_resampling": r"""
        with steps as (select unnest(range(256))::bigint as v),
        codes as (  -- the crc of one byte
            select list(list_reduce([v, 1, 2, 3, 4, 5, 6, 7, 8],
                lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) order by v) as code from steps),
        texts as (
            select doc_id as id, false as wanted, text from documents union all select null, true, text from benchmark),
        split as (
            select row_number() over () as r, id, wanted, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
            from texts),
        used as (select r, wanted, word, count(*) as n from (select r, wanted, unnest(w) as word from split) group by all),
        bytes as (
            select word, list_transform(range(0, strlen(word)), lambda k: ('0x' || substr(hex(encode(word)), 2 * k + 1, 2))::bigint) as b
            from (select distinct word from used)),
        hashed as (
            select word, xor(list_reduce(list_prepend(4294967295::bigint, b), lambda c, x: xor(c // 256, code[xor(c % 256, x) + 1])), 4294967295) % 10000 as bucket
            from bytes, codes),
        found as (select r, wanted, bucket, sum(n)::bigint as n from used join hashed using (word) group by all),
        totals as (
            select bucket, coalesce(sum(n) filter (not wanted), 0)::double as s, coalesce(sum(n) filter (wanted), 0)::double as t from found group by bucket),
        gain as (
            select bucket, floor(1000 * ln((t + 1) * ((select sum(s) from totals) + 10000) / ((s + 1) * ((select sum(t) from totals) + 10000))))::bigint as g
            from totals),
        weights as (select r, floor(sum(n * g)::double / sum(n))::bigint as weight from found join gain using (bucket) where not wanted group by r),
        scored as (
            select id as doc_id, len(w)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
                coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(id::varchar, '')), 1, 8))::bigint + 0.5) / 4294967296::double)))::bigint as score
            from split left join weights using (r) where not wanted),
        ranks as (
            select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as n from scored where n_features >= 20)
        select doc_id, n_features, weight, score, case when place <= n * 10 // 100 then place end::bigint as rank
        from scored left join ranks using (doc_id)
    """,
    "op12_line_dedup": r"""
        with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
        l as (
            select doc_id, pos, lines[pos] as line, translate(trim(lines[pos], concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
            from (select doc_id, lines, unnest(range(1, len(lines) + 1)) as pos from d)),
        k as (select key, max(doc_id) as keeper from l where length(key) >= 20 group by key having count(distinct doc_id) >= 3)
        select doc_id, count(*) as n_lines, count(*) filter (keeper <> doc_id) as n_dropped,
            sha256(coalesce(string_agg(line, chr(10) order by pos) filter (keeper is null or keeper = doc_id), '')) as kept_sha256
        from l left join k using (key) group by doc_id
    """,
    "op13_fill_in_middle": r"""
        with d as (
            select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as t,
                sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents),
        c as (
            select *, len(t)::bigint as n, ('0x' || h[1:8])::bigint % (len(t) + 1) as a, ('0x' || h[9:16])::bigint % (len(t) + 1) as b,
                case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or ('0x' || h[17:24])::bigint % 100 >= 90 then 'plain'
                    when ('0x' || h[25:32])::bigint % 100 < 20 then 'spm' else 'psm' end as form from d),
        p as (
            select *, array_to_string(t[1 : least(a, b)], '') as one, array_to_string(t[least(a, b) + 1 : greatest(a, b)], '') as two,
                array_to_string(t[greatest(a, b) + 1 :], '') as three from c)
        select doc_id, n, form, case when form <> 'plain' then length(one) end::bigint as prefix_chars,
            case when form <> 'plain' then length(two) end::bigint as middle_chars,
            sha256(case form when 'plain' then text when 'psm' then '<P>' || one || '<S>' || three || '<M>' || two
                else '<S>' || three || '<P>' || one || '<M>' || two end) as output_sha256,
            sha256(text) as restored_sha256
        from p
    """,
}
