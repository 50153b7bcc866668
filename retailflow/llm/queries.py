"""Registered queries of the text operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.llm import (
    chat_format, code_clusters, decontaminate, fill_middle, html_extract, line_dedup, lm_score, minhash, neighbours, packing, pii,
    quality, warc,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = line_dedup.dedup_lines(_table(spark, folder, "documents"))
    return rows.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(_table(spark, folder, "embeddings"))


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    return pii.find(documents, pii.train(documents))


def op4_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.score_documents(_table(spark, folder, "documents"))


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    rows = decontaminate.find_passages(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op6_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.link_documents(_table(spark, folder, "documents"))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The documents the classifier selects, with their grade and its probability."""
    documents = _table(spark, folder, "documents")
    model = quality.train(documents, quality.ratings_of(_table(spark, folder, "labels")))
    return quality.grade(documents, model).where("kept").select("row.doc_id", "expected_grade", "top_probability", "kept")


def op8_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.main_text(_table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    rows = warc.round_trip(_table(spark, folder, "pages"))
    return rows.select(
        F.col("metadata.page_id").alias("page_id"),
        F.coalesce("response.payload_bytes", "original.payload_bytes").alias("payload_bytes"),
        F.coalesce("response.payload_digest", "original.payload_digest").alias("payload_digest"),
        F.col("response.kind").alias("record_type"),
        F.when(F.col("response.kind") == "revisit", F.col("original.page_id")).alias("refers_to"),
    )


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"))


def op11_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    rows = fill_middle.fill_middle(_table(spark, folder, "documents"))
    rows = rows.withColumn("parts", fill_middle.taken_apart(F.col("output"), F.col("form")))
    back = fill_middle.restored(F.col("output"), F.col("form"), F.col("parts"))
    return rows.select(
        "row.doc_id", "n", "form", F.length("parts.prefix").cast("long").alias("prefix_chars"),
        F.length("parts.middle").cast("long").alias("middle_chars"), F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"))


def op12_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one more, -1, whose texts are full of control strings."""
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return chat_format.read_back(chat_format.format_conversations(turns), in_order=True)


def op13_code_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return code_clusters.cluster(_table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_neighbours": op2_neighbours,
    "op3_pii": op3_pii,
    "op4_lm_score": op4_lm_score,
    "op5_decontaminate": op5_decontaminate,
    "op6_minhash": op6_minhash,
    "op7_quality": op7_quality,
    "op8_html_extract": op8_html_extract,
    "op9_warc": op9_warc,
    "op10_packing": op10_packing,
    "op11_fill_middle": op11_fill_middle,
    "op12_chat_format": op12_chat_format,
    "op13_code_clusters": op13_code_clusters,
}

# The template's control strings, as `chat_format.Template` has them.
_CONTROLS = ("[SYS]", "[/SYS]", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[TEXT]", "[/ROLE]")


def _escaped_chars(text: str) -> str:
    """SQL for the length of an escaped text: one character more for each escape and each control string."""
    return " + ".join([f"length({text})", f"length({text}) - length(replace({text}, chr(92), ''))", *[
        f"(length({text}) - length(replace({text}, '{c}', ''))) // {len(c)}" for c in _CONTROLS]])


ORACLE = {
    "op1_line_dedup": """
        with docs as (select doc_id, coalesce(text, '') as text from documents),
        lines as (
          select doc_id, unnest(string_split(text, chr(10))) as line,
                 unnest(range(1, len(string_split(text, chr(10))) + 1)) as pos
          from docs),
        keyed as (
          select doc_id, pos, line,
                 translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
          from lines),
        firsts as (
          select key, min(doc_id) as keeper from keyed where length(key) >= 10
          group by key having count(distinct doc_id) > 1),
        marked as (
          select k.doc_id, k.pos, k.line, f.keeper is not null and k.doc_id > f.keeper as lost
          from keyed k left join firsts f on k.key = f.key)
        select doc_id, count(*) as n_lines, count(*) filter (where lost) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not lost), '')) as kept_sha256
        from marked group by doc_id""",
    "op9_warc": """
        with p as (
          select page_id, sha1(coalesce(html, '')) as digest, octet_length(encode(coalesce(html, ''))) as size
          from pages),
        owners as (select digest, max(page_id) as owner from p where size >= 1000 group by digest)
        select p.page_id, p.size as payload_bytes, p.digest as payload_digest,
               case when o.owner is null or o.owner = p.page_id then 'response' else 'revisit' end as record_type,
               case when o.owner <> p.page_id then o.owner end as refers_to
        from p left join owners o on p.digest = o.digest""",
    "op11_fill_middle": """
        with t as (select doc_id, coalesce(text, '') as text, sha256('7:' || coalesce(doc_id::varchar, '')) as h from documents),
        units as (
          select *, string_split(text, chr(10)) as parts,
                 case when text = '' then 0
                      else len(string_split(text, chr(10))) - (case when right(text, 1) = chr(10) then 1 else 0 end) end as n
          from t),
        drawn as (
          select *, ('0x' || substr(h, 1, 8))::bigint % (n + 1) as c1, ('0x' || substr(h, 9, 8))::bigint % (n + 1) as c2,
                 case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
                        or ('0x' || substr(h, 17, 8))::bigint % 100 >= 100 then 'plain'
                      when ('0x' || substr(h, 25, 8))::bigint % 100 < 50 then 'spm' else 'psm' end as form
          from units),
        lengths as (
          select *,
                 case when least(c1, c2) = 0 then 0 else least(length(text), length(array_to_string(parts[1:least(c1, c2)], chr(10))) + 1) end::bigint as p,
                 case when greatest(c1, c2) = 0 then 0 else least(length(text), length(array_to_string(parts[1:greatest(c1, c2)], chr(10))) + 1) end::bigint as q
          from drawn)
        select doc_id, n::bigint as n, form, case when form <> 'plain' then p end as prefix_chars,
               case when form <> 'plain' then q - p end as middle_chars,
               sha256(case form
                 when 'plain' then text
                 when 'psm' then '<P>' || substr(text, 1, p) || '<S>' || substr(text, q + 1) || '<M>' || substr(text, p + 1, q - p)
                 else '<S>' || substr(text, q + 1) || '<P>' || substr(text, 1, p) || '<M>' || substr(text, p + 1, q - p)
               end) as output_sha256,
               sha256(text) as restored_sha256
        from lengths""",
    "op12_chat_format": f"""
        with turns as (
          select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
          union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
        placed as (
          select *, row_number() over w as i, count(*) over (partition by conv_id) as n, lag(role) over w as before
          from turns window w as (partition by conv_id order by turn nulls first, role, text)),
        marked as (
          select *, case role when 'system' then 11 when 'user' then 13 when 'assistant' then 7
                              else 19 + {_escaped_chars("role")} end + {_escaped_chars("text")} as chars,
                 case when role = 'system' then i = 1
                      when role = 'user' then i = 1 or before in ('system', 'assistant')
                      when role = 'assistant' then before = 'user' else false end as fits
          from placed)
        select conv_id, count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
               coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
               sha256(coalesce(string_agg(text, '' order by i) filter (where role = 'assistant'), '')) as loss_sha256,
               sum(chars)::bigint as formatted_chars, bool_and(coalesce(fits, false)) as valid,
               bool_and(coalesce(fits, false)) and arg_max(role, i) = 'assistant' as complete
        from marked group by conv_id""",
}
