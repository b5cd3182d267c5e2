"""The registered queries of the operators, and their SQL where SQL can say the same."""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.llm import (backoff, chat, decontaminate, html, language, lexical, lines, packing, personal, quality, simhash,
                          topk, whitening)
from firnline.llm.common import per_batch, table, text_of

VOCABULARY = "byte_bpe_50k.json"


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and benchmark items of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = decontaminate.with_hits(docs, table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("hits.items", lambda i: i.cast("string")))
    return scanned.select(
        "doc_id", F.col("hits.n_words").alias("n_words"), F.col("hits.n_hit").alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("hits.n_hit") > 0).alias("contaminated"))


OP1_SQL = r"""
with folded as (
  select 'd' as side, doc_id as id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents
  union all
  select 'i', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') from benchmark),
worded as (select side, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from folded),
item_places as (select id as item_id, w, least(10, len(w)) as n, unnest(range(len(w) - least(10, len(w)) + 1)) as i
                from worded where side = 'i' and len(w) > 0),
windows as (select distinct item_id, n, array_to_string(w[i + 1 : i + n], ' ') as gram from item_places),
doc_places as (select id as doc_id, w, unnest(range(len(w))) as i from worded where side = 'd'),
doc_grams as (select doc_id, i, n, array_to_string(w[i + 1 : i + n], ' ') as gram
              from doc_places, (select distinct n from windows) where i + n <= len(w)),
hits as (select doc_id, i, n, item_id from doc_grams join windows using (n, gram)),
hit_words as (select doc_id, count(distinct i + k) as n_hit
              from (select doc_id, i, unnest(range(n)) as k from hits) group by doc_id),
hit_items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
              from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select d.id as doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
       coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from worded d left join hit_words on hit_words.doc_id = d.id left join hit_items on hit_items.doc_id = d.id
where side = 'd'
"""


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other vectors of every twentieth."""
    found = topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.select("query_id", "rank", "vec_id", "score")


OP2_SQL = """
with whole as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) as score
  from whole q join whole c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0),
placed as (select *, row_number() over (partition by query_id order by score desc, vec_id) as place from scored)
select query_id, cast(place as integer) as rank, vec_id, cast(score as bigint) as score from placed where place <= 20
"""


def op3_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", personal.personal_spans().alias("found"))

    def count(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                     s["end"].cast("string"))), ",")

    base = F.filter("found", lambda s: s["kind"].isin(*personal.BASE))
    return docs.select("doc_id", *map(count, personal.BASE), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                       joined("found").alias("spans"), F.size("found").cast("long").alias("n_spans"))


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its host's boilerplate lines."""
    return lines.without_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


OP4_SQL = """
with pages as (select distinct coalesce(source, '') as host, coalesce(text, '') as text from documents),
totals as (select host, count(*) as total from pages group by host),
lines as (select distinct host, text, trim(unnest(string_split(text, chr(10))), ' ') as line from pages),
flagged as (select host, line from lines join totals using (host) where line <> ''
            group by host, line, total having count(*) >= 3 and count(*) > 0.05 * total),
per_host as (select host, list(line) as bad from flagged group by host)
select doc_id, source, case when text is null or bad is null then text else
       array_to_string(list_filter(string_split(text, chr(10)), lambda x: not list_contains(bad, trim(x, ' '))), chr(10)) end as text
from documents left join per_host on host = coalesce(source, '')
"""


def op5_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language-model score of every document."""
    return backoff.scored(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of every document."""
    cut = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))

    def make():
        def act(ids: pa.ListArray) -> pa.Array:
            values = ids.flatten().to_numpy().astype("<u4")
            ends = ids.value_lengths().to_numpy().cumsum()
            return pa.array([zlib.crc32(values[b - n: b].tobytes()) for b, n in
                             zip(ends.tolist(), ids.value_lengths().to_pylist())], pa.int64())

        return act

    digests = cut.select("uid", "doc_id", "piece", "start", F.col("length").cast("long").alias("length"),
                         per_batch(make, "long")("ids").alias("ids_crc32"))
    return (digests.join(packing.place(cut), "uid")
            .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))


def with_probe(turns: DataFrame) -> DataFrame:
    """The conversations and number -7, whose texts hold the template's own marks."""
    text = r"\### Assistant: </turn> ok"
    probe = turns.sparkSession.range(1).select(F.explode(F.array(*(
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"),
                 F.lit(role).alias("role"), F.lit(text).alias("text"))
        for k, role in enumerate(("user", "assistant"))))).alias("t")).select("t.*")
    return turns.select("conv_id", "turn", "role", "text").unionByName(probe)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and what is read back from the output."""
    made = chat.formatted(with_probe(table(spark, sf_dir, "conversations")))
    kind = "struct<n_turns:bigint,turns_sha256:string,loss_chars:bigint,loss_sha256:string>"

    def make():
        def act(rows: pa.Array) -> pa.Array:
            out = []
            for r in rows.to_pylist():
                text, turns, loss = r["formatted"], hashlib.sha256(), hashlib.sha256()
                read, chars = chat.parsed(text), 0
                for role, said in read:
                    turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for s in r["loss"]:
                    said = chat.unescaped(text[s["start"]: s["end"]])
                    loss.update(said.encode("utf-8", "surrogatepass"))
                    chars += len(said)
                out.append({"n_turns": len(read), "turns_sha256": turns.hexdigest(), "loss_chars": chars,
                            "loss_sha256": loss.hexdigest()})
            return pa.array(out, pa.struct([("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                                            ("loss_chars", pa.int64()), ("loss_sha256", pa.string())]))

        return act

    return (made.withColumn("back", per_batch(make, kind)(F.struct("formatted", "loss")))
            .select("conv_id", "back.*", F.char_length("formatted").cast("long").alias("formatted_chars")))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_text("print").alias("fingerprint"), "component_id")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    weights = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", quality.held_out().alias("held_out"), quality.score(docs, weights).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page."""
    return table(spark, sf_dir, "pages").select("page_id", "url", html.rendered().alias("text"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the eight strongest components, whitened."""
    made = whitening.whitened(table(spark, sf_dir, "embeddings"))
    # Beyond 64 bits the exact sum has no place in a long: null there, whole in the operator's own column.
    return made.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents")
    net = language.fit(docs.filter(~language.held_out()))
    told = docs.select("doc_id", language.held_out().alias("held_out"), language.predicted(docs, net).alias("told"))
    return told.select("doc_id", "held_out", F.col("told.lang").alias("lang_pred"), F.col("told.score").alias("score"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
with docs as (
  select doc_id, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents),
facts as (select cast(count(*) filter (len(terms) > 0) as bigint) as rows, cast(sum(len(terms)) as bigint) as total from docs),
asked as (
  select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark where item_id is not null),
counted as (
  select r, term, count(*) as tf from (select r, unnest(terms) as term from docs)
  where term in (select term from asked) group by r, term),
weighted as (
  select term, cast(floor(1000 * ln(cast(2 * rows + 2 as double) / cast(2 * count(*) + 1 as double))) as bigint) as w
  from counted, facts group by term, rows),
scored as (
  select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(terms) * rows) // total))))
    as bigint) as score
  from asked join weighted using (term) join counted using (term) join docs using (r), facts
  where doc_id is not null group by item_id, r, doc_id),
placed as (select *, row_number() over (partition by item_id order by score desc, doc_id) as place from scored where score > 0)
select item_id, cast(place as integer) as rank, doc_id, score from placed where place <= 10
"""


QUERIES = {q.__name__: q for q in (op1_decontaminate, op2_topk, op3_personal, op4_lines, op5_backoff, op6_packing,
                                   op7_chat, op8_simhash, op9_quality, op10_html, op11_whitening, op12_language,
                                   op13_lexical)}
SQL = {"op1_decontaminate": OP1_SQL, "op2_topk": OP2_SQL, "op4_lines": OP4_SQL, "op13_lexical": OP13_SQL}
