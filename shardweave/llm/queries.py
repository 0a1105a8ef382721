"""Queries of the problems tagged llm, with SQL where SQL can express them."""

from __future__ import annotations

import unicodedata as ud

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode_corpus
from .budget import encoded_counts, text_counts, token_cube
from .copies import collapse_copies, copy_classes
from .curve_packing import fill_report, pack_sequences
from .leaks import find_leaks
from .lookalikes import consistent_text, look_alike_members, look_alike_pairs
from .mixture import draw_mix, shard_items
from .pair_defects import find_defects, question_pairs


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def p1_sequences(spark: SparkSession, sf: str) -> DataFrame:
    return pack_sequences(_read(spark, sf, "tokenized"))


def p1_fill(spark: SparkSession, sf: str) -> DataFrame:
    return fill_report(p1_sequences(spark, sf))


def p1_samples(spark: SparkSession, sf: str) -> DataFrame:
    """What became of each sample: pieces, ids, and the sums of its ids and of its mask."""
    cut = lambda c: F.slice(c, F.col("p.starts") + 1, F.col("p.lengths"))
    pieces = p1_sequences(spark, sf).select("input_ids", "loss_mask", F.explode(F.arrays_zip("sample_ids", "starts", "lengths")).alias("p"))
    total = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x)
    rows = pieces.select(F.col("p.sample_ids").alias("sample_id"), F.col("p.lengths").alias("n"), total(cut("input_ids")).alias("ids"), total(cut("loss_mask")).alias("mask"))
    return rows.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_pieces"), F.sum("n").alias("n_ids"), F.max("n").cast("bigint").alias("longest"), F.sum("ids").alias("id_sum"), F.sum("mask").alias("mask_sum"))


def p2_mix(spark: SparkSession, sf: str) -> DataFrame:
    return draw_mix(shard_items(_read(spark, sf, "shard_index")), _read(spark, sf, "mix_targets")).drawn


def p2_shares(spark: SparkSession, sf: str) -> DataFrame:
    return draw_mix(shard_items(_read(spark, sf, "shard_index")), _read(spark, sf, "mix_targets")).report


def p2_mix_totals(spark: SparkSession, sf: str) -> DataFrame:
    """What was drawn of each source, shard by shard added up; no shard is drawn more often than the mean rounded up."""
    drawn = p2_mix(spark, sf)
    return drawn.groupBy("source").agg(F.sum("n_drawn").alias("n_drawn"), F.max("passes").cast("bigint").alias("passes"), F.max(F.col("n_drawn") > F.col("passes") * F.col("size")).alias("over"))


def p2_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """The same mix of documents, by characters; a text that several sources carry is one item of all of them."""
    d = _read(spark, sf, "documents").filter("n_chars > 0 and source is not null")
    members = d.groupBy(F.sha2("text", 256).alias("item"), F.lower(F.trim("source")).alias("source")).agg(F.max("n_chars").alias("size"))
    return draw_mix(members, _read(spark, sf, "mix_targets")).report


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return copy_classes(_read(spark, sf, "manifest")).filter("rec_id <> first_id").select("first_id", "rec_id")


def p3_collapsed(spark: SparkSession, sf: str) -> DataFrame:
    return collapse_copies(_read(spark, sf, "manifest"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return find_defects(question_pairs(_read(spark, sf, "manifest_qa"), _read(spark, sf, "packed")))


def _counts(spark: SparkSession, sf: str) -> DataFrame:
    encoded = encoded_counts(_read(spark, sf, "tokenized")).withColumn("tab", F.lit("tokenized"))
    texts = text_counts(_read(spark, sf, "manifest")).withColumn("tab", F.lit("manifest"))
    return encoded.unionByName(texts)


def p6_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _counts(spark, sf).select("tab", "rec_id", "source", "lang", "domain", "n_tokens")


def p6_totals(spark: SparkSession, sf: str) -> DataFrame:
    return token_cube(_counts(spark, sf))


def p6_encoded_totals(spark: SparkSession, sf: str) -> DataFrame:
    return token_cube(encoded_counts(_read(spark, sf, "tokenized")))


def p7_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encode_corpus(_read(spark, sf, "documents"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return find_leaks(_read(spark, sf, "documents"), _read(spark, sf, "eval_items")).select("doc_id", "item_id").distinct()


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return look_alike_pairs(_read(spark, sf, "documents"))


def p9_members(spark: SparkSession, sf: str) -> DataFrame:
    out = look_alike_members(_read(spark, sf, "documents"))
    return out.select(F.col("id").alias("doc_id"), "class_id", "n_texts", "n_rows")


def p9_forms(spark: SparkSession, sf: str) -> DataFrame:
    return consistent_text(_read(spark, sf, "documents").select("doc_id", "text")).select("doc_id", "form")


QUERIES = {
    "p1_sequences": p1_sequences,
    "p1_fill": p1_fill,
    "p1_samples": p1_samples,
    "p2_mix": p2_mix,
    "p2_shares": p2_shares,
    "p2_mix_totals": p2_mix_totals,
    "p2_overlap": p2_overlap,
    "p3_found": p3_found,
    "p3_collapsed": p3_collapsed,
    "p5_found": p5_found,
    "p6_counts": p6_counts,
    "p6_totals": p6_totals,
    "p6_encoded_totals": p6_encoded_totals,
    "p7_ids": p7_ids,
    "p8_found": p8_found,
    "p9_found": p9_found,
    "p9_members": p9_members,
    "p9_forms": p9_forms,
}
_STRIP = r"[^\p{L}\p{N}\p{M}]+"


def _folded(c: str) -> str:
    return f"regexp_replace(upper(replace({c}, 'ß', 'SS')), '{_STRIP}', '', 'g')"


_NAME = r"^\s*([A-Za-z_]\w*)\s*[:=]"
_FIELD = _folded("json_extract_string(value, '$.\"' || k || '\"')")
_NAMED = _folded(f"regexp_extract(x, '{_NAME}', 1)") + " || ' = ' || " + _folded(f"regexp_replace(x, '{_NAME}', '')")
_RECORDS = rf"""
WITH b AS (
  SELECT rec_id, {_folded("video_path")} AS path, value, CASE WHEN json_valid(value) THEN json_type(value) END AS kind
  FROM manifest WHERE regexp_matches(value, '[^\s\p{{Z}}\p{{C}}]')),
t AS (SELECT rec_id, path, kind, value, CASE WHEN kind = 'VARCHAR' THEN json_extract_string(value, '$') ELSE value END AS text FROM b),
p AS (SELECT *, [x FOR x IN regexp_split_to_array(text, '[;|\n\r]+') IF trim(x, ' ' || chr(9)) <> ''] AS parts FROM t),
r AS (
  SELECT rec_id, path,
    CASE WHEN kind = 'OBJECT' THEN CAST(list_sort([{_folded("k")} || ' = ' || {_FIELD} FOR k IN json_keys(value)]) AS VARCHAR)
         WHEN len(parts) > 1 AND len([x FOR x IN parts IF regexp_matches(x, '{_NAME}')]) = len(parts) THEN CAST(list_sort([{_NAMED} FOR x IN parts]) AS VARCHAR)
         ELSE {_folded("text")} END AS record
  FROM p),
c AS (SELECT rec_id, min(rec_id) OVER w AS first_id, count(*) OVER w AS n FROM r WINDOW w AS (PARTITION BY path, record))
"""


# Pairs of letters that are drawn alike, the one to keep first.  Written out anew, so that the SQL does not lean on the operator's table.
_PAIRS = (
    "aа aα aɑ cс cϲ dԁ eе gɡ hһ iі iι jј jϳ lӏ oо oο pр pρ qԛ sѕ vѵ wԝ xх yу yγ AА AΑ BВ BΒ CС CϹ EЕ EΕ GԌ HН HΗ IІ IΙ JЈ KК KΚ MМ MΜ NΝ OО OΟ PР PΡ QԚ SЅ TТ TΤ VѴ WԜ XХ XΧ "
    "YУ YΥ YҮ ZΖ ΦФ φф ΠП κк εє ΓГ"
)
_GONE = [0xAD, 0x34F, 0x61C, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065), *range(0x2066, 0x206A), *range(0xFE00, 0xFE10), 0xFEFF]
_BLANK = [0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000]
_BY_UNICODE = (*range(0x2E80, 0x2FE0), *range(0xF900, 0xFB00), *range(0xFF01, 0xFFE7), *range(0x2F800, 0x2FA1E))


def _look_alike_sql(body: str) -> str:
    """Texts rewritten by single characters after canonical composition: enough to tell the classes of pairs apart."""
    swap = dict(x[::-1] for x in _PAIRS.split()) | dict.fromkeys(map(chr, _BLANK), " ") | {"\u2010": "-", "\u2011": "-"}
    swap |= {chr(n): x for n in _BY_UNICODE if len(x := ud.normalize("NFKC", chr(n))) == 1 and x != chr(n)}
    for c in map(chr, (*range(0x370, 0x530), *range(0x1F00, 0x2000))):  # composed letters of other scripts, by their base
        base, *marks = ud.normalize("NFD", c)
        if marks and len(x := ud.normalize("NFC", swap.get(base, base) + "".join(marks))) == 1 and x != c:
            swap[c] = x
    old, new = "".join(swap), "".join(swap.values())
    form = f"nfc_normalize(translate(nfc_normalize(translate(text, '{''.join(map(chr, _GONE))}', '')), '{old}', '{new.replace("'", "''")}'))"
    return f"""
WITH f AS (SELECT doc_id, text, {form} AS form FROM documents WHERE text IS NOT NULL),
v AS (SELECT * FROM f WHERE regexp_matches(form, '[^\\s\\p{{Z}}\\p{{C}}\\p{{M}}]'))
{body}
"""


_SHARDS = """
WITH i AS (
  SELECT regexp_replace(regexp_replace(trim(url), '^s3[an]://', 's3://'), '([^:])/{2,}', '\\1/', 'g') AS u, nsamples, indexed_at FROM shard_index WHERE nsamples IS NOT NULL AND url IS NOT NULL),
n AS (SELECT regexp_extract(u, '^(.*?/?)pack/', 1) AS root, lower(regexp_extract(u, 'pack/([^/]+)/', 1)) AS source, regexp_extract(u, 'pack/[^/]+/(.*)$', 1) AS rest, nsamples, indexed_at FROM i),
s AS (SELECT source, arg_max(nsamples, (indexed_at, nsamples)) AS size FROM n GROUP BY root, source, rest),
a AS (SELECT m.source, m.target_share, m.max_repeats, CAST(coalesce((SELECT sum(size) FROM s WHERE s.source = m.source), 0) AS BIGINT) AS avail FROM mix_targets m),
w AS (SELECT *, target_share / (SELECT sum(target_share) FROM a WHERE avail > 0) AS share FROM a),
t AS (SELECT min(CAST(ceil((max_repeats * avail + 1 - 1e-9) / share) - 1 AS BIGINT)) AS total FROM w WHERE avail > 0),
d AS (SELECT source, target_share, max_repeats, avail, CASE WHEN avail > 0 THEN CAST(floor(total * share + 1e-9) AS BIGINT) ELSE 0 END AS drawn FROM w, t)
"""
_REPORT = """
SELECT source, target_share, max_repeats, avail AS n_available, CAST(drawn AS BIGINT) AS n_drawn,
       CASE WHEN avail > 0 THEN round(drawn / avail, 6) ELSE 0.0 END AS repeats, round(drawn / (SELECT sum(drawn) FROM d), 6) AS actual_share
FROM d
"""
# The largest total at which no set of sources has a larger quota than its items can give, over all sets of sources.
_OVERLAP = """
WITH m AS (SELECT DISTINCT text, lower(trim(source)) AS source, n_chars AS size FROM documents WHERE n_chars > 0 AND source IS NOT NULL),
a AS (SELECT x.source, x.target_share, x.max_repeats, CAST(coalesce((SELECT sum(size) FROM m WHERE m.source = x.source), 0) AS BIGINT) AS avail FROM mix_targets x),
w AS (SELECT source, target_share / sum(target_share) OVER () AS share, max_repeats AS reps, CAST(row_number() OVER (ORDER BY source) - 1 AS INT) AS k FROM a WHERE avail > 0),
p AS (SELECT list(w.k) AS ks, max(size) AS size, max(w.reps) AS top FROM m JOIN w USING (source) GROUP BY text),
q AS (SELECT list_sort(ks) AS ks, any_value(top) AS top, sum(size) AS size FROM p GROUP BY 1),
z AS (SELECT unnest(range(1, CAST(pow(2, (SELECT count(*) FROM w)) AS BIGINT))) AS id),
g AS (SELECT z.id, sum(w.share) AS share, count(*) AS n FROM z JOIN w ON (z.id >> w.k) & 1 = 1 GROUP BY z.id),
c AS (SELECT z.id, q.ks, any_value(q.size) AS size, any_value(q.top) AS top, sum(w.reps) AS reps FROM z, q JOIN w ON list_contains(q.ks, w.k) WHERE (z.id >> w.k) & 1 = 1 GROUP BY z.id, q.ks),
r AS (SELECT id, CAST(sum(size * least(top, reps)) AS BIGINT) AS room FROM c GROUP BY id),
e AS (SELECT g.id, r.room, unnest(range(CAST(floor(r.room / g.share) AS BIGINT) - 1, CAST(ceil((r.room + g.n) / g.share) AS BIGINT) + 2)) AS total FROM g JOIN r USING (id)),
o AS (SELECT e.id, e.total, e.room, sum(CAST(floor(e.total * w.share + 1e-9) AS BIGINT)) AS asked FROM e JOIN w ON (e.id >> w.k) & 1 = 1 GROUP BY ALL),
t AS (SELECT min(total) AS total FROM (SELECT id, max(total) AS total FROM o WHERE asked <= room GROUP BY id)),
d AS (SELECT a.source, a.target_share, a.max_repeats, a.avail, coalesce(CAST(floor(t.total * w.share + 1e-9) AS BIGINT), 0) AS drawn FROM t, a LEFT JOIN w USING (source))
"""


ORACLES = {
    "p1_samples": """
WITH u AS (SELECT sample_id, input_ids, max(len(coalesce(loss_mask, []))) AS n_mask, arg_max(coalesce(loss_mask, []), len(coalesce(loss_mask, []))) AS mask FROM tokenized WHERE len(input_ids) > 0 GROUP BY sample_id, input_ids)
SELECT sample_id, CAST(sum(ceil(len(input_ids) / 8000.0)) AS BIGINT) AS n_pieces, CAST(sum(len(input_ids)) AS BIGINT) AS n_ids, CAST(max(least(len(input_ids), 8000)) AS BIGINT) AS longest,
       CAST(sum(list_sum(input_ids)) AS BIGINT) AS id_sum, CAST(sum(coalesce(list_sum(mask[:len(input_ids)]), 0)) AS BIGINT) AS mask_sum
FROM u GROUP BY sample_id
""",
    "p2_shares": _SHARDS + _REPORT,
    "p2_mix_totals": _SHARDS + "SELECT source, CAST(drawn AS BIGINT) AS n_drawn, CAST(ceil(drawn / avail) AS BIGINT) AS passes, false AS over FROM d WHERE drawn > 0",
    "p2_overlap": _OVERLAP + _REPORT,
    "p3_found": _RECORDS + "SELECT first_id, rec_id FROM c WHERE rec_id <> first_id",
    "p3_collapsed": _RECORDS
    + """SELECT rec_id, CAST(n AS BIGINT) AS n_copies FROM c WHERE rec_id = first_id
UNION ALL SELECT rec_id, CAST(1 AS BIGINT) FROM manifest WHERE rec_id NOT IN (SELECT rec_id FROM c)""",
    "p9_found": _look_alike_sql("SELECT a.doc_id AS doc_a, b.doc_id AS doc_b FROM v a JOIN v b ON a.form = b.form AND a.doc_id < b.doc_id AND a.text <> b.text"),
    "p9_members": _look_alike_sql("""SELECT doc_id, min(doc_id) OVER w AS class_id, n_texts, CAST(count(*) OVER w AS BIGINT) AS n_rows
FROM v JOIN (SELECT form, count(DISTINCT text) AS n_texts FROM v GROUP BY form HAVING n_texts > 1) USING (form) WINDOW w AS (PARTITION BY form)"""),
    "p6_encoded_totals": """
WITH r AS (
  SELECT sample_id,
         CASE WHEN trim(coalesce(source, '')) = '' THEN 'unknown' ELSE lower(trim(source)) END AS source,
         coalesce(nullif(lower(regexp_extract(lang, '^\\s*([A-Za-z]{2,3})([-_].*)?\\s*$', 1)), ''), 'und') AS lang,
         CASE WHEN trim(coalesce(domain, '')) = '' THEN 'unknown' ELSE lower(trim(domain)) END AS domain,
         coalesce(len(input_ids), 0) AS n
  FROM tokenized),
one AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY n DESC, source DESC, lang DESC, domain DESC) = 1)
SELECT CASE WHEN grouping(source) = 1 THEN 'ALL' ELSE source END AS source,
       CASE WHEN grouping(lang) = 1 THEN 'ALL' ELSE lang END AS lang,
       CASE WHEN grouping(domain) = 1 THEN 'ALL' ELSE domain END AS domain,
       CAST(count(*) AS BIGINT) AS n_records, CAST(sum(n) AS BIGINT) AS n_tokens
FROM one GROUP BY CUBE (source, lang, domain)
""",
}
