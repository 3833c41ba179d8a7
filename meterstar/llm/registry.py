"""The registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstar.llm import bpe, chat, jaccard, lexical, licenses, packing, quality_cnn, quality_rules, secrets, simhash, topk, toxicity, whitening
from meterstar.llm.common import read_table

# A conversation whose texts are nothing but another template's control strings.
HOSTILE = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def _judged(scored: DataFrame, held_out: Column) -> DataFrame:
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_documents(
        docs, read_table(spark, sf_dir, "labels"), learn_from=toxicity.fold("id", 5) != 0,
        keep_text=False,
    )
    return _judged(scored, toxicity.fold("doc_id", 5) == 0)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan_secrets(read_table(spark, sf_dir, "documents")))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topk.vectors(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(rows.filter(F.col("id") % 20 == 0), rows)


def op4_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_cnn.score_documents(
        docs, read_table(spark, sf_dir, "labels"), learn_from=toxicity.fold("id", 3) != 1,
        keep_text=False,
    )
    return _judged(scored, toxicity.fold("doc_id", 3) == 1)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return quality_rules.digest(quality_rules.judge(docs, keep_text=False))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(bpe.encode_documents(read_table(spark, sf_dir, "documents")))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan_licenses(read_table(spark, sf_dir, "documents")))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), keep_ids=False)


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(HOSTILE, rows.schema))
    return chat.digest(chat.format_log(chat.log_of_turns(rows)))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_documents(read_table(spark, sf_dir, "documents"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(read_table(spark, sf_dir, "embeddings"))


def op13_dual_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search_documents(
        read_table(spark, sf_dir, "benchmark"), read_table(spark, sf_dir, "documents")
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_secrets": op2_secrets,
        "op3_topk": op3_topk,
        "op4_quality_cnn": op4_quality_cnn,
        "op5_quality_rules": op5_quality_rules,
        "op6_bpe": op6_bpe,
        "op7_licenses": op7_licenses,
        "op8_packing": op8_packing,
        "op9_chat": op9_chat,
        "op10_jaccard_join": op10_jaccard_join,
        "op11_simhash": op11_simhash,
        "op12_whitening": op12_whitening,
        "op13_dual_tree": op13_dual_tree,
        "pipeline": corpus_pipeline.run,
    }


OP9_SQL = r"""
with turns as (
    select conv_id, turn, role, coalesce(text, '') as text from conversations
    union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                     (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized as (
    select *, length(role) + length(text) + length('<|turn|><|text|><|end|>') + 1
        + len(regexp_extract_all(role, '\\|<\||\[/?INST\]|</?s>|<</?SYS>>|\[/?[A-Z_]+\]'))
        + len(regexp_extract_all(text, '\\|<\||\[/?INST\]|</?s>|<</?SYS>>|\[/?[A-Z_]+\]'))
        as formatted
    from turns)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), ''))
           as loss_sha256,
       cast(sum(formatted) as bigint) as formatted_chars
from sized group by conv_id
"""


OP3_SQL = """
with scaled as (
    select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v
    from embeddings
    where embedding is not null and vec_id is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
    from scaled q join scaled c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0),
ranked as (
    select query_id, cast(row_number() over (partition by query_id
        order by score desc, vec_id) as int) as rank, vec_id, score from scored)
select * from ranked where rank <= 20
"""

# Documents have unique ids here, so a row is a document. Lines are compared as normalised
# text where the query compares their hashes.
OP5_SQL = rf"""
with docs as (select doc_id, coalesce('=' || source, '') as host, coalesce(text, '') as text
              from documents),
words as (
    select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i, len(w) as n
    from (select doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from docs)),
windows as (
    select doc_id, i, string_agg(word, ' ') over eight as gram, count(*) over eight as size
    from words window eight as (partition by doc_id order by i
                                rows between current row and 7 following)),
again as (
    select doc_id, i from (
        select doc_id, i, count(*) over (partition by doc_id, gram) as k
        from windows where size = 8) where k > 1),
covered as (
    select doc_id, count(distinct i + o) as n_repeat_words
    from again, (select unnest(range(8)) as o) group by doc_id),
measured as (
    select doc_id, count(*) as n_words, cast(sum(length(word)) as bigint) as word_chars
    from words group by doc_id),
lines as (
    select doc_id, host, text_id, i, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as n,
           regexp_replace(translate(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'), ' '),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[0-9]+', '0', 'g') as mark
    from (select doc_id, host, md5(text) as text_id, unnest(string_split(text, chr(10))) as line,
                 generate_subscripts(string_split(text, chr(10)), 1) as i from docs)
    where regexp_matches(line, '[^\x20\x09-\x0D]')),
duplicates as (
    select doc_id, count(*) - count(distinct line) as n_dup_lines from lines group by doc_id),
hosts as (select host, count(distinct md5(text)) as documents from docs group by host),
frequent as (
    select l.host, mark from lines l join hosts h on l.host = h.host
    group by l.host, mark, documents
    having count(distinct text_id) >= {quality_rules.MIN_DOCUMENTS}
       and count(distinct text_id) > {quality_rules.SHARE} * documents),
removed as (
    select doc_id, sum(n) as gone from lines l
    join frequent f on l.host = f.host and l.mark = f.mark group by doc_id),
joined as (
    select d.doc_id, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0) as word_chars,
           cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint)
               as n_symbols,
           coalesce(n_dup_lines, 0) as n_dup_lines,
           coalesce(n_repeat_words, 0) as n_repeat_words,
           coalesce(n_words, 0) - coalesce(gone, 0) as rest
    from docs d left join measured using (doc_id) left join duplicates using (doc_id)
    left join covered using (doc_id) left join removed using (doc_id)),
failed as (
    select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from joined)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and rest >= {quality_rules.MIN_WORDS}
           and 100 * rest >= {quality_rules.KEEP_PERCENT} * n_words as kept
from failed
"""


OP10_SQL = r"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
grams as (
    select distinct doc_id, g from (
        select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
            else list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) end)
            as g from words)),
sizes as (select doc_id, count(*) as n from grams group by doc_id),
-- Of linked sets, at least 90 % of either is common, so the 10 % of n-grams that are
-- rarest, and one more, have a common one.
rare as (
    select doc_id, g from (
        select g.doc_id, g.g, n, row_number() over (partition by g.doc_id order by f, g.g) as r
        from grams g join (select g, count(*) as f from grams group by g) using (g)
        join sizes using (doc_id))
    where r <= n - cast(ceil(0.9 * n) as bigint) + 1),
pairs as (
    select distinct a.doc_id as a, b.doc_id as b from rare a join rare b
    on a.g = b.g and a.doc_id < b.doc_id),
common as (
    select p.a, p.b, count(*) as o from pairs p
    join grams x on x.doc_id = p.a join grams y on y.doc_id = p.b and y.g = x.g group by p.a, p.b),
links as (
    select a, b from common join sizes s on s.doc_id = a join sizes t on t.doc_id = b
    where 100 * o >= 90 * (s.n + t.n - o)),
edges as (select a, b from links union all select b, a from links),
-- Links to sets other than the document's own, equal sets once.
sets as (select doc_id, md5(string_agg(g, chr(10) order by g)) as k from grams group by doc_id),
linked as (
    select a as doc_id, count(distinct y.k) as n_links from edges
    join sets x on x.doc_id = a join sets y on y.doc_id = b where x.k <> y.k group by a),
reach(node, seen) as (
    select doc_id, doc_id from documents
    union select reach.node, edges.b from reach join edges on edges.a = reach.seen)
select d.doc_id, coalesce(n, 0) as n_shingles, c.component_id,
       coalesce(n_links, 0) as n_links
from documents d left join sizes using (doc_id) left join linked using (doc_id)
join (select node as doc_id, min(seen) as component_id from reach group by node) c using (doc_id)
"""


OP13_SQL = r"""
with texts as (
    select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w
    from documents where text is not null),
sized as (select doc_id, w, len(w) as n from texts where len(w) > 0),
totals as (select count(*) as docs, cast(sum(n) as bigint) as terms from sized),
asked as (
    select item_id, term, count(*) as q from (
        select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
        from benchmark)
    group by item_id, term),
held as (
    select doc_id, term, n, count(*) as tf from (select doc_id, n, unnest(w) as term from sized)
    where term in (select term from asked) group by doc_id, term, n),
weighed as (
    select term, cast(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) as bigint) as weight
    from held, totals group by term),
scored as (
    select item_id, doc_id, cast(sum(q * weight * ((1000000000 * tf) //
               (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) as bigint) as score
    from asked join held using (term) join weighed using (term), totals group by item_id, doc_id),
ranked as (
    select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int)
               as rank, doc_id, score
    from scored where score > 0)
select * from ranked where rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_topk": OP3_SQL, "op10_jaccard_join": OP10_SQL, "op5_quality_rules": OP5_SQL,
            "op9_chat": OP9_SQL, "op13_dual_tree": OP13_SQL}
