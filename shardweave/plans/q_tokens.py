"""Conversations, tokens and packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import conversation as conv
from ..functions.tokenizers import WordTokenizer, conversation_ids, input_ids, loss_mask, padded_vocab_size_col
from ..operators import packing, quality


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def lengths(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents")
    return d.select("source", "doc_id", F.coalesce(F.col("n_chars"), F.lit(0)).cast("int").alias("n"))


def pack_nextfit(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_groups(lengths(spark, sf), "source", "doc_id", "n").select("source", "doc_id", F.col("bin").cast("bigint").alias("bin"))


def pack_fold(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_folded(lengths(spark, sf), "source", "doc_id", "n").select("source", "doc_id", F.col("bin").cast("bigint").alias("bin"))


def pack_summary(spark: SparkSession, sf: str) -> DataFrame:
    p = packing.pack_groups(lengths(spark, sf), "source", "doc_id", "n", keep_tail=True)
    n, total = F.count(F.lit(1)), F.sum("n")
    return p.groupBy("source", F.col("bin").cast("bigint").alias("bin")).agg(n.alias("n_samples"), total.alias("n_tokens"), packing.merged_length(total, n).alias("merged"))


PACK_SQL = """
WITH RECURSIVE r AS (
  SELECT source, doc_id, CAST(coalesce(n_chars, 0) AS BIGINT) AS n, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents),
f AS (
  SELECT source, doc_id, n, k, CAST(0 AS BIGINT) AS bin, CASE WHEN n < 8000 THEN n ELSE 0 END AS used, CASE WHEN n < 8000 THEN 1 ELSE 0 END AS c FROM r WHERE k = 1
  UNION ALL
  SELECT r.source, r.doc_id, r.n, r.k, f.bin + x.cl,
         CASE WHEN x.cl = 1 THEN 0 ELSE f.used END + CASE WHEN r.n < 8000 THEN r.n ELSE 0 END,
         CASE WHEN x.cl = 1 THEN 0 ELSE f.c END + CASE WHEN r.n < 8000 THEN 1 ELSE 0 END
  FROM f JOIN r ON r.source IS NOT DISTINCT FROM f.source AND r.k = f.k + 1,
       LATERAL (SELECT CASE WHEN f.used + r.n > 8000 AND f.c > 0 THEN 1 ELSE 0 END AS cl) x)
"""


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "packed").select("sample_id", "url", F.col("info.conversations").alias("raw"), "image_name_list")
    once = p.groupBy("sample_id").agg(F.min_by(F.struct("url", "raw", "image_name_list"), "url").alias("r")).select("sample_id", "r.*")
    return once.select("sample_id", "url", conv.normal_turns(F.col("raw")).alias("turns"), "image_name_list")


TURN_SQL = """
WITH t AS (
  SELECT sample_id, any_value(url) AS url,
         [{'role': CASE WHEN lower(trim(x."from")) IN ('user', 'human') THEN 'human' WHEN lower(trim(x."from")) IN ('assistant', 'gpt') THEN 'gpt' ELSE lower(trim(x."from")) END,
           'value': x.value} FOR x IN any_value(info.conversations)] AS turns,
         any_value(image_name_list) AS names
  FROM packed GROUP BY sample_id)
"""
WORD_SQL = r"(<unk>|<s>|</s>|<im_patch>|<im_start>|<im_end>|[\p{L}\p{N}]+|[^\s\p{L}\p{N}])"


def conversation_render(spark: SparkSession, sf: str) -> DataFrame:
    return _turns(spark, sf).select("sample_id", conv.render(F.col("turns")).alias("text"))


def loss_mask_counts(spark: SparkSession, sf: str) -> DataFrame:
    t = _turns(spark, sf).withColumn("parts", conversation_ids(F.col("turns"), WordTokenizer()))
    total = F.aggregate(loss_mask(F.col("parts")), F.lit(0), lambda a, b: a + b)
    return t.select("sample_id", F.size(input_ids(F.col("parts"))).cast("bigint").alias("n_ids"), total.cast("bigint").alias("n_loss"))


COUNT_SQL = f"""
n AS (
  SELECT sample_id, url, [{{'silent': x.role IN ('human', 'system'), 'n': len(regexp_extract_all(coalesce(x.value, '') || CASE WHEN x.role = 'gpt' THEN '</s>' ELSE '' END, '{WORD_SQL}'))}} FOR x IN turns] AS parts
  FROM t WHERE turns IS NOT NULL),
m AS (SELECT sample_id, url, CAST(1 + coalesce(list_sum([x.n FOR x IN parts]), 0) AS BIGINT) AS n_ids, CAST(coalesce(list_sum([x.n FOR x IN parts IF NOT x.silent]), 0) AS BIGINT) AS n_loss FROM n)
"""


def prompt_txt_split(spark: SparkSession, sf: str) -> DataFrame:
    t = _turns(spark, sf)
    p, r = conv.prompts(F.col("turns")), conv.replies(F.col("turns"))
    return t.select("sample_id", F.size(p).cast("bigint").alias("n_prompt"), F.size(r).cast("bigint").alias("n_txt"), F.array_join(p, "\n").alias("prompts"), F.array_join(r, "\n").alias("txts"))


def special_count_filter(spark: SparkSession, sf: str) -> DataFrame:
    t = _turns(spark, sf)
    n = conv.human_image_tags(F.col("turns"))
    return t.select("sample_id", n.cast("bigint").alias("n_tags"), F.greatest(F.size("image_name_list"), F.lit(0)).cast("bigint").alias("n_images")).filter("n_tags = n_images")


def image_expand_length(spark: SparkSession, sf: str) -> DataFrame:
    t = _turns(spark, sf)
    first = conv.expand_turns(F.col("turns"))
    return t.select("sample_id", F.aggregate(first, F.lit(0), lambda a, x: a + F.coalesce(F.length(x["value"]), F.lit(0))).cast("bigint").alias("n_chars"))


def qa_questions(spark: SparkSession, sf: str) -> DataFrame:
    q = read(spark, sf, "manifest_qa").select("qa_id", F.posexplode("value").alias("pair_no", "m"))
    return q.select("qa_id", F.col("pair_no").cast("bigint").alias("pair_no"), conv.question_of_map(F.col("m")).alias("question")).distinct()


def chat_turns(spark: SparkSession, sf: str) -> DataFrame:
    q = read(spark, sf, "manifest_qa").filter(F.size("value") > 0)
    t = q.select("qa_id", conv.chat_turns(F.col("value"), conv.VIDEO).alias("t"))
    return t.select("qa_id", F.size("t").cast("bigint").alias("n_turns"), F.col("t")[0]["value"].alias("first_human"), F.element_at("t", -1)["value"].alias("last_reply")).distinct()


def caption_denylist(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "manifest").filter(F.col("value").isNotNull() & ~conv.has_black_word(F.col("value"))).select("rec_id")


def word_ids(spark: SparkSession, sf: str) -> DataFrame:
    ids = WordTokenizer().ids(F.col("text"))
    d = read(spark, sf, "documents").select("doc_id", ids.alias("ids"))
    return d.select("doc_id", F.size("ids").cast("bigint").alias("n"), F.aggregate("ids", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("id_sum"))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    t = _turns(spark, sf).filter("turns is not null").withColumn("parts", conversation_ids(F.col("turns"), WordTokenizer()))
    total = F.aggregate(loss_mask(F.col("parts")), F.lit(0), lambda a, b: a + b)
    n = t.select("url", "sample_id", F.size(input_ids(F.col("parts"))).alias("n"), total.alias("loss"))
    p = packing.pack_groups(n, "url", "sample_id", "n", 512, keep_tail=True)
    c, s = F.count(F.lit(1)), F.sum("n")
    return p.groupBy("url", F.col("bin").cast("bigint").alias("bin")).agg(c.alias("n_samples"), packing.merged_length(s, c).alias("n_tokens"), F.sum("loss").alias("n_loss"))


FLAG_SQL = (
    "WITH RECURSIVE"
    + TURN_SQL.strip()[4:]
    + ","
    + COUNT_SQL
    + """,
r AS (SELECT url, sample_id, n_ids AS n, n_loss, row_number() OVER (PARTITION BY url ORDER BY sample_id) AS k FROM m),
f AS (
  SELECT url, sample_id, n, n_loss, k, CAST(0 AS BIGINT) AS bin, CASE WHEN n < 512 THEN n ELSE 0 END AS used, CASE WHEN n < 512 THEN 1 ELSE 0 END AS c FROM r WHERE k = 1
  UNION ALL
  SELECT r.url, r.sample_id, r.n, r.n_loss, r.k, f.bin + x.cl, CASE WHEN x.cl = 1 THEN 0 ELSE f.used END + CASE WHEN r.n < 512 THEN r.n ELSE 0 END,
         CASE WHEN x.cl = 1 THEN 0 ELSE f.c END + CASE WHEN r.n < 512 THEN 1 ELSE 0 END
  FROM f JOIN r ON r.url = f.url AND r.k = f.k + 1, LATERAL (SELECT CASE WHEN f.used + r.n > 512 AND f.c > 0 THEN 1 ELSE 0 END AS cl) x)
SELECT url, bin, count(*) AS n_samples, CAST(sum(n) - (count(*) - 1) AS BIGINT) AS n_tokens, CAST(sum(n_loss) AS BIGINT) AS n_loss FROM f WHERE n < 512 GROUP BY url, bin
"""
)


def pair_violations(spark: SparkSession, sf: str) -> DataFrame:
    return quality.pair_violations(read(spark, sf, "tokenized")).select("sample_id", "violation").distinct()


def token_id_counts(spark: SparkSession, sf: str) -> DataFrame:
    t = read(spark, sf, "tokenized").filter("input_ids is not null")
    return t.select("sample_id", *[quality.id_count(F.col("input_ids"), v).cast("bigint").alias(f"n_{v}") for v in (32000, 32001, 32002)]).distinct()


def vocab_padding(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "part").select("p_partkey", padded_vocab_size_col(F.col("p_partkey"), 128, 4).alias("padded"))


QUERIES = {f.__name__: f for f in (pack_nextfit, pack_fold, pack_summary, conversation_render, loss_mask_counts, prompt_txt_split, special_count_filter, image_expand_length, qa_questions, chat_turns, caption_denylist, word_ids, pair_violations, token_id_counts, vocab_padding)}
QUERIES["conversation_pack"] = flagship
_BINS = PACK_SQL + "SELECT source, doc_id, bin FROM f WHERE n < 8000 AND bin < (SELECT max(g.bin) FROM f g WHERE g.source IS NOT DISTINCT FROM f.source)"
ORACLES = {
    "pack_nextfit": _BINS,
    "pack_fold": _BINS,
    "pack_summary": PACK_SQL + "SELECT source, bin, count(*) AS n_samples, CAST(sum(n) AS BIGINT) AS n_tokens, CAST(sum(n) - (count(*) - 1) AS BIGINT) AS merged FROM f WHERE n < 8000 GROUP BY source, bin",
    "conversation_render": TURN_SQL + "SELECT sample_id, '<s>' || array_to_string([coalesce(x.value, '') || CASE WHEN x.role = 'gpt' THEN '</s>' ELSE '' END FOR x IN turns], chr(10)) AS text FROM t",
    "loss_mask_counts": TURN_SQL + "," + COUNT_SQL + "SELECT sample_id, n_ids, n_loss FROM m",
    "prompt_txt_split": TURN_SQL
    + """, s AS (SELECT sample_id, [turns[i].value FOR i IN range(1, len(turns) + 1) IF i % 2 = 1 AND turns[i].role = 'human'] AS p,
                    [turns[i].value FOR i IN range(1, len(turns) + 1) IF i % 2 = 0 AND turns[i].role = 'gpt'] AS r FROM t)
       SELECT sample_id, len(p) AS n_prompt, len(r) AS n_txt, CASE WHEN p IS NOT NULL THEN coalesce(array_to_string(p, chr(10)), '') END AS prompts, CASE WHEN r IS NOT NULL THEN coalesce(array_to_string(r, chr(10)), '') END AS txts FROM s""",
    "special_count_filter": TURN_SQL
    + """, s AS (SELECT sample_id, CAST(coalesce(list_sum([coalesce((length(x.value) - length(replace(x.value, '<image>', ''))) // 7, 0) FOR x IN turns IF x.role = 'human']), 0) AS BIGINT) AS n_tags,
                    CAST(coalesce(len(names), 0) AS BIGINT) AS n_images FROM t WHERE turns IS NOT NULL)
       SELECT * FROM s WHERE n_tags = n_images""",
    "image_expand_length": TURN_SQL
    + """SELECT sample_id, CASE WHEN turns IS NULL THEN NULL ELSE CAST(coalesce(list_sum([coalesce(CASE WHEN x.role = 'human'
              THEN length(replace(x.value, '<image>', '<im_start>' || repeat('<im_patch>', 256) || '<im_end>')) ELSE length(x.value) END, 0) FOR x IN turns]), 0) AS BIGINT) END AS n_chars FROM t""",
    "qa_questions": """
      SELECT DISTINCT qa_id, CAST(i - 1 AS BIGINT) AS pair_no, array_to_string([value[i][k] FOR k IN map_keys(value[i]) IF k <> 'a'], '') AS question
      FROM (SELECT qa_id, value, unnest(range(1, len(value) + 1)) AS i FROM manifest_qa WHERE len(value) > 0)""",
    "chat_turns": """
      SELECT DISTINCT qa_id, CAST(2 * len(value) AS BIGINT) AS n_turns, array_to_string([value[1][k] FOR k IN map_keys(value[1]) IF k <> 'a'], '') || '<video>' AS first_human,
             coalesce(value[len(value)]['a'], '') AS last_reply FROM manifest_qa WHERE len(value) > 0""",
    "caption_denylist": "SELECT rec_id FROM manifest WHERE value IS NOT NULL AND NOT ("
    + " OR ".join(f"contains(lower(value), '{w}')" for w in conv.BLACK_WORDS)
    + ")",
    "word_ids": f"""
      WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '{WORD_SQL}'), []) AS w FROM documents)
      SELECT doc_id, len(w) AS n, CAST(coalesce(list_sum([CASE x WHEN '<unk>' THEN 0 WHEN '<s>' THEN 1 WHEN '</s>' THEN 2 WHEN '<im_patch>' THEN 32000 WHEN '<im_start>' THEN 32001 WHEN '<im_end>' THEN 32002
             ELSE CAST('0x' || substr(md5(x), 1, 8) AS BIGINT) % 30000 + 3 END FOR x IN w]), 0) AS BIGINT) AS id_sum FROM w""",
    "pair_violations": """
      WITH c AS (SELECT sample_id, input_ids AS i, loss_mask AS m, len([x FOR x IN input_ids IF x = 32001]) AS s, len([x FOR x IN input_ids IF x = 32002]) AS e, len([x FOR x IN input_ids IF x = 32000]) AS p FROM tokenized),
      v AS (SELECT sample_id, CASE WHEN i IS NULL OR len(i) = 0 THEN 'no_ids' WHEN m IS NULL OR len(i) <> len(m) THEN 'mask_length' WHEN len(i) >= 8000 THEN 'too_long'
                   WHEN s <> e THEN 'image_ends' WHEN p <> s * 256 THEN 'image_patches' END AS violation FROM c)
      SELECT DISTINCT * FROM v WHERE violation IS NOT NULL""",
    "token_id_counts": "SELECT DISTINCT sample_id, " + ", ".join(f"len([x FOR x IN input_ids IF x = {v}]) AS n_{v}" for v in (32000, 32001, 32002)) + " FROM tokenized WHERE input_ids IS NOT NULL",
    "vocab_padding": "SELECT p_partkey, CAST(ceil(p_partkey / 512.0) * 512 AS BIGINT) AS padded FROM part",
    "conversation_pack": FLAG_SQL,
}
