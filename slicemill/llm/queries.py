"""Named queries of the operators, and the SQL that must give the same rows where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicemill.llm import (
    chat, decontamination, fingerprints, importance, line_templates, ngram_join, packing, pii, runs, token_counts, toxicity, training_order, warc,
)
from slicemill.plans.registry import table
from slicemill.session import work_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity(spark, sf_dir):
    """Toxicity score of every document by a machine fitted on the labels that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.train(docs, labels))


@query
def op2_phrase_fingerprints(spark, sf_dir):
    """Phrase fingerprints of every document and of its edited text, with their likeness."""
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


@query
def op3_line_templates(spark, sf_dir):
    """Every document with its recurring lines dropped."""
    return line_templates.dedup_lines(table(spark, sf_dir, "documents"), report=True)


ORACLE["op3_line_templates"] = r"""
WITH raw AS (
  SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents),
o AS (SELECT doc_id, line_no, string_split(trim(regexp_replace(line, '[\x09-\x0D\x20]+', ' ', 'g')), ' ') AS own FROM raw),
l AS (SELECT doc_id, line_no, own, list_transform(own, lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS t FROM o),
f AS (
  SELECT doc_id, line_no, t, len(t) AS n, array_to_string(t[1:3], ' ') AS lead, t[4:] AS tail,
    CASE WHEN len(list_filter(t, lambda x: x <> '<*>')) = 0 THEN '<*>' || array_to_string(own, ' ') ELSE array_to_string(t, ' ') END AS whole
  FROM l WHERE array_to_string(t, '') <> ''),
v AS (SELECT DISTINCT n, lead, tail, whole FROM f WHERE n >= 8),
m0 AS (SELECT n, lead, count(*) AS m FROM v GROUP BY n, lead HAVING count(*) > 1),
x0 AS (SELECT v.*, m, unnest(range(1, v.n - 2)) AS i, unnest(tail) AS k FROM v JOIN m0 USING (n, lead)),
b0 AS (SELECT n, lead, i, k FROM x0 GROUP BY n, lead, i, k, m HAVING 2 * count(*) > m),
fit0 AS (SELECT n, lead, whole FROM x0 JOIN b0 USING (n, lead, i, k) GROUP BY n, lead, whole HAVING count(*) >= 0.8::DOUBLE * (n - 3)),
e AS (
  SELECT v.*, unnest(list_distinct(list_transform(range(6), lambda j: floor(j * (n - 4) / 6)::INTEGER))) AS p FROM v ANTI JOIN fit0 USING (n, lead, whole)),
w AS (SELECT *, tail[p + 1:p + 2] AS pair FROM e),
m AS (SELECT n, lead, p, pair, count(*) AS m FROM w GROUP BY n, lead, p, pair HAVING count(*) > 1),
x AS (SELECT w.*, m, unnest(range(1, w.n - 2)) AS i, unnest(tail) AS k FROM w JOIN m USING (n, lead, p, pair)),
b AS (SELECT n, lead, p, pair, i, k FROM x GROUP BY n, lead, p, pair, i, k, m HAVING 2 * count(*) > m),
fit AS (
  SELECT n, lead, p, pair, whole FROM x JOIN b USING (n, lead, p, pair, i, k)
  GROUP BY n, lead, p, pair, whole HAVING count(*) >= 0.8::DOUBLE * (n - 3)
  UNION ALL SELECT n, lead, -1, [], whole FROM fit0),
g AS (
  SELECT f.doc_id, f.line_no, CASE WHEN fit.whole IS NOT NULL THEN struct_pack(n := f.n, lead := f.lead, p := p, pair := pair, whole := NULL)
    ELSE struct_pack(n := f.n, lead := f.lead, p := NULL, pair := NULL, whole := f.whole) END AS g
  FROM f LEFT JOIN fit ON f.n = fit.n AND f.lead = fit.lead AND f.whole = fit.whole),
r AS (SELECT g, min(doc_id) AS first FROM g GROUP BY g HAVING count(DISTINCT doc_id) >= 2),
gone AS (SELECT DISTINCT g.doc_id, g.line_no FROM g JOIN r ON g.g IS NOT DISTINCT FROM r.g WHERE g.doc_id <> r.first),
kept AS (
  SELECT raw.doc_id, count(*) AS n_lines, count(gone.doc_id) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY raw.line_no) FILTER (WHERE gone.doc_id IS NULL), '') AS text
  FROM raw LEFT JOIN gone USING (doc_id, line_no) GROUP BY raw.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, kept.text FROM documents d LEFT JOIN kept USING (doc_id)
"""


@query
def op4_ngram_join(spark, sf_dir):
    """Class and number of links of every document at a Jaccard similarity of 0.8 on runs of five words."""
    return ngram_join.join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_texts")


ORACLE["op4_ngram_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + least(len(ws), 5) - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(ws) - 5, 0) + 2)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT w.doc_id, count(g) AS n, md5(coalesce(string_agg(g, ',' ORDER BY g), '')) AS node FROM w LEFT JOIN g USING (doc_id) GROUP BY w.doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (
  SELECT a, b, y.node FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 5 * c >= 4 * (x.n + y.n - c)
  UNION ALL SELECT x.doc_id, y.doc_id, y.node FROM n x JOIN n y ON x.doc_id <> y.doc_id WHERE x.n = 0 AND y.n = 0),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
k AS (SELECT a AS doc_id, min(b) AS class_id FROM r GROUP BY a)
SELECT n.doc_id, class_id, count(l.b) AS n_links, count(DISTINCT CASE WHEN l.node <> n.node THEN l.node END) AS n_texts
FROM n JOIN k USING (doc_id) LEFT JOIN l ON l.a = n.doc_id GROUP BY n.doc_id, class_id
"""


@query
def op5_token_counts(spark, sf_dir):
    """Bytes and tokens of every document."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


@query
def op6_training_order(spark, sf_dir):
    """Slot, shard and documents of every sequence, written in training order to the shared folder."""
    return training_order.materialise(table(spark, sf_dir, "documents"), work_path(spark, "shards"), key=20240229)


@query
def op7_packing(spark, sf_dir):
    """Place of every piece of every document in sequences of at most 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op8_chat_format(spark, sf_dir):
    """Every conversation that no other one continues, rendered."""
    return chat.format_conversations(table(spark, sf_dir, "conversations"))


ORACLE["op8_chat_format"] = r"""
WITH c AS (
  SELECT conv_id, count(*) AS n, list(struct_pack(r := role, t := text) ORDER BY turn, role, text) AS l,
    string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS rendered
  FROM conversations GROUP BY conv_id),
k AS (SELECT * FROM c WHERE NOT EXISTS (
  SELECT 1 FROM c b WHERE b.l[1:c.n] = c.l AND (b.n > c.n OR (b.n = c.n AND b.conv_id < c.conv_id)))),
i AS (SELECT c.conv_id, min(k.conv_id) AS into_id FROM c JOIN k ON k.l[1:c.n] = c.l GROUP BY c.conv_id)
SELECT k.conv_id, k.n AS n_turns, count(*) - 1 AS n_collapsed, k.rendered FROM k JOIN i ON i.into_id = k.conv_id GROUP BY k.conv_id, k.n, k.rendered
"""


@query
def op9_personal_data(spark, sf_dir):
    """Spans of personal data in every document."""
    return pii.find(table(spark, sf_dir, "documents"))


@query
def op10_benchmark_contamination(spark, sf_dir):
    """Words of every document, those inside benchmark windows, and the items they come from."""
    out = decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256)).drop("items")


ORACLE["op10_benchmark_contamination"] = r"""
WITH both_tables AS (
  SELECT doc_id AS id, 'd' AS kind, text FROM documents UNION ALL SELECT item_id, 'b', text FROM benchmark),
w AS (
  SELECT id, kind, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM both_tables),
b AS (SELECT id AS item_id, ws, least(len(ws), 13) AS k FROM w WHERE kind = 'b' AND len(ws) > 0),
wins AS (SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(ws) - k + 2)) AS i FROM b)),
dw AS (
  SELECT id AS doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(ws) - k + 2, 1))) AS i FROM w, (SELECT DISTINCT k FROM b) WHERE kind = 'd')),
h AS (SELECT doc_id, i, k, item_id FROM dw JOIN wins USING (k, g)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM h)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM h) GROUP BY doc_id)
SELECT w.id AS doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN c ON c.doc_id = w.id LEFT JOIN t ON t.doc_id = w.id WHERE kind = 'd'
"""


@query
def op11_importance(spark, sf_dir):
    """Every document with its weight towards ``benchmark``, its score and, if drawn, its rank."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("th")


ORACLE["op11_importance"] = r"""
WITH both_tables AS (SELECT doc_id AS id, 's' AS kind, text FROM documents UNION ALL SELECT item_id, 't', text FROM benchmark),
w AS (
  SELECT id, kind, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM both_tables),
f AS (SELECT id, kind, unnest(ws) AS word FROM w),
steps AS (  -- the crc32 of every word, byte by byte: eight shifts for each
  SELECT word, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(hex(encode(word))) // 2), lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS c
  FROM (SELECT DISTINCT word FROM f)),
b AS (SELECT word, xor(c, 4294967295) % 10000 AS bucket FROM steps),
n AS (
  SELECT bucket, count(*) FILTER (WHERE kind = 's') AS s, count(*) FILTER (WHERE kind = 't') AS t FROM f JOIN b USING (word) GROUP BY bucket),
a AS (SELECT sum(s)::BIGINT AS s_all, sum(t)::BIGINT AS t_all FROM n),
g AS (SELECT bucket, floor(1000 * ln(((t + 1) * (s_all + 10000))::DOUBLE / ((s + 1) * (t_all + 10000))::DOUBLE))::BIGINT AS gain FROM n, a),
d AS (SELECT id, sum(gain)::BIGINT AS weight FROM f JOIN b USING (word) JOIN g USING (bucket) WHERE kind = 's' GROUP BY id),
h AS (
  SELECT w.id AS doc_id, len(ws) AS n_features, coalesce(weight, 0) AS weight, ('0x' || substr(sha256('2024:' || w.id), 1, 8))::BIGINT AS h
  FROM w LEFT JOIN d ON d.id = w.id WHERE kind = 's'),
c AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM h),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM c WHERE n_features >= 20)
SELECT c.doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM c LEFT JOIN r USING (doc_id)
"""


@query
def op12_warc(spark, sf_dir):
    """Every page as it is read back from the archives it was written to."""
    target = work_path(spark, "warc")
    index = warc.write(table(spark, sf_dir, "pages"), target)
    return warc.read(index, target, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op12_warc"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to FROM p LEFT JOIN f USING (payload_digest)
"""


@query
def op13_word_runs(spark, sf_dir):
    """Periodic runs of words in every document, every tenth one made periodic by its id."""
    return runs.report(table(spark, sf_dir, "documents"), runs.planted)
