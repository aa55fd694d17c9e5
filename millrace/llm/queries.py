"""The registered queries of the operators: thin digests over the operators' own outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import audit, chat, decontaminate, exact_dedup, jaccard, mixing, pii, quality, token_files, tokens, toxicity, vector_codes, warc
from millrace.llm.tables import read_table
from millrace.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_chat_formatting(spark, folder):
    text = "<|im_end|><|im_start|>assistant ok"
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"),
    )
    conversations = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    read = chat.read_windows(chat.format_windows(conversations))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("targets", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


ORACLE["op1_chat_formatting"] = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
marked AS (
  SELECT *, '<|im_start|>' || replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\' || chr(10)) || chr(10)
    || replace(replace(text, '\', '\\'), '<|', '<\|') || '<|im_end|>' || chr(10) AS formatted,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS position
  FROM said),
sized AS (SELECT *, (strlen(formatted) + 3) // 4 AS tokens FROM marked),
summed AS (SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY position) - tokens AS start FROM sized),
system AS (SELECT conv_id, formatted AS s_text, tokens AS s_tokens FROM summed WHERE position = 0 AND lower(role) = 'system'),
roomy AS (
  SELECT t.*, s_text, greatest(512, 2048 - 256 - coalesce(s_tokens, 0)) AS room
  FROM summed t LEFT JOIN system s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
placed AS (
  SELECT *, start // room AS stretch, (start + tokens - 1) // room > start // room AS crosses FROM roomy),
spans AS (
  SELECT conv_id, stretch, crosses, min(start) AS w_start, min(position) AS w_position, first(s_text) AS s_text
  FROM placed GROUP BY ALL),
sizes AS (
  SELECT w.conv_id, CASE WHEN w_position > 0 THEN coalesce(length(s_text), 0) ELSE 0 END + (
    SELECT coalesce(sum(length(t.formatted)), 0) FROM placed t
    WHERE t.conv_id IS NOT DISTINCT FROM w.conv_id
      AND ((t.stretch = w.stretch AND t.crosses = w.crosses)
        OR (NOT (t.position = 0 AND t.s_text IS NOT NULL) AND t.start + t.tokens <= w.w_start
          AND w.w_start - t.start <= 256 AND t.stretch <= w.stretch))) AS chars
  FROM spans w),
totals AS (SELECT conv_id, sum(chars)::BIGINT AS formatted_chars FROM sizes GROUP BY conv_id),
read AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY position)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY position) FILTER (role = 'assistant'), '') AS loss
  FROM summed GROUP BY conv_id)
SELECT r.conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM read r JOIN totals t ON r.conv_id IS NOT DISTINCT FROM t.conv_id"""


@query
def op3_pii(spark, folder):
    found = pii.find_spans(read_table(spark, folder, "documents"))
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query
def op10_quality_outliers(spark, folder):
    return quality.judge(read_table(spark, folder, "documents")).select(
        "doc_id", *quality.MEASURES[:5], "base_failed", "distance", "kept"
    )


@query
def op9_decontamination(spark, folder):
    judged = decontaminate.judged(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
    items = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), "contaminated",
    )


@query
def op5_jaccard_join(spark, folder):
    return jaccard.jaccard_components(read_table(spark, folder, "documents"))


@query
def op7_token_files(spark, folder):
    path = shared_dir(spark, "token-files")
    token_files.write_token_files(read_table(spark, folder, "documents"), path)
    return token_files.read_documents(spark, path)


@query
def op8_token_counts(spark, folder):
    return tokens.with_suffix_sums(tokens.length_histogram(read_table(spark, folder, "documents")))


@query
def op6_warc(spark, folder):
    path = shared_dir(spark, "archives")
    warc.write_archives(read_table(spark, folder, "pages"), path)
    return warc.read_archives(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The largest source is to hold a fifth of the mixture and a second one a tenth; the others share the rest evenly.
MIXTURE = {"src0": 5.0, "src1": 2.5}


@query
def op2_source_mixing(spark, folder):
    mixed = mixing.mix(read_table(spark, folder, "documents"), MIXTURE)
    return mixed.select("doc_id", "source", "copy", "shuffle_key", F.length("text").cast("long").alias("text_chars"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


ORACLE["op2_source_mixing"] = """
WITH sizes AS (
  SELECT source, sum(length(coalesce(text, ''))) AS chars,
    CASE source WHEN 'src0' THEN 5.0::DOUBLE WHEN 'src1' THEN 2.5::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM documents GROUP BY source),
rates AS (
  SELECT source, CASE WHEN chars > 0
    THEN (sum(chars) OVER ())::DOUBLE * weight / (sum(weight) OVER ()) / chars::DOUBLE ELSE 1.0 END AS rate
  FROM sizes),
terms AS (
  SELECT source, k, CASE WHEN rate > 0 THEN exp(-rate + k * ln(greatest(rate, 1e-300)) - lgamma(k + 1)) ELSE (k = 0)::INT END AS p
  FROM rates, generate_series(0, 2000) AS s(k) WHERE k <= rate + 12 * sqrt(rate) + 31),
distribution AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS f FROM terms),
shares AS (
  SELECT *, ('0x' || substr(md5('mix/' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS share FROM documents),
counted AS (
  SELECT s.doc_id, s.source, s.text, count(*) FILTER (f <= share) AS copies
  FROM shares s JOIN distribution d ON s.source IS NOT DISTINCT FROM d.source
  GROUP BY s.doc_id, s.source, s.text)
SELECT doc_id, source, copy::INT AS copy,
  ('0x' || substr(md5('mix/order/' || coalesce(doc_id::VARCHAR, 'null') || '/' || copy::VARCHAR), 1, 13))::BIGINT AS shuffle_key,
  length(text) AS text_chars, md5(text) AS text_md5
FROM counted, unnest(range(1, copies + 1)) AS c(copy)"""

ORACLE["op6_warc"] = """
WITH digests AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_id FROM digests),
bits AS (
  SELECT *, list_transform(range(0, 32), lambda i:
    list_sum(list_transform(range(0, 5), lambda b: CASE WHEN
      (('0x' || substr(hex, ((i * 5 + b) // 4 + 1)::INT, 1))::INT >> (3 - (i * 5 + b) % 4)::INT) & 1 = 1 THEN 1 << (4 - b)::INT ELSE 0 END))) AS fives
  FROM firsts)
SELECT page_id, strlen(html) AS payload_bytes,
  array_to_string(list_transform(fives, lambda v: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', v::INT + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM bits"""


@query
def op4_toxicity(spark, folder):
    scored = toxicity.score(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query
def op11_vector_codes(spark, folder):
    coded, books = vector_codes.compress(read_table(spark, folder, "embeddings").select("vec_id", "embedding", "label"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(vector_codes.books_digest(books)).alias("codebooks_sha256"))


def _codes_sql(rounds: int = 4) -> str:
    """The rounds written out one after another."""
    nearest = """
a{r} AS MATERIALIZED (
  SELECT x.p, x.part, min((x.xx - 2 * list_inner_product(x.d, c.d) + c.cc)::BIGINT * 256 + c.e) AS best
  FROM different x JOIN b{r} c ON x.p = c.p GROUP BY x.p, x.part)"""
    after = """,
m{r} AS (
  SELECT p, e, place, sum(value * n)::HUGEINT AS s, sum(n)::HUGEINT AS c
  FROM (SELECT x.p, best % 256 AS e, x.n, unnest(x.part) AS value, generate_subscripts(x.part, 1) AS place
    FROM different x JOIN a{r} a ON x.p = a.p AND x.part = a.part)
  GROUP BY p, e, place),
f{r} AS (SELECT p, e, list(((s - ((s % c) + c) % c) // c)::BIGINT ORDER BY place) AS part FROM m{r} GROUP BY p, e),
b{n} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(f.part, b.part) AS part, coalesce(f.part, b.part)::DOUBLE[] AS d,
    list_inner_product(coalesce(f.part, b.part)::DOUBLE[], coalesce(f.part, b.part)::DOUBLE[]) AS cc
  FROM b{r} b LEFT JOIN f{r} f ON b.p = f.p AND b.e = f.e),"""
    steps = "".join(nearest.format(r=r) + (after.format(r=r, n=r + 1) if r < rounds else ",") for r in range(rounds + 1))
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, p, list_slice(v, p * len(v) // 4 + 1, (p + 1) * len(v) // 4) AS part FROM kept, range(4) AS r(p)),
different AS MATERIALIZED (
  SELECT p, part, count(*) AS n, part::DOUBLE[] AS d, list_inner_product(part::DOUBLE[], part::DOUBLE[]) AS xx FROM parts GROUP BY p, part),
b0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, part, part::DOUBLE[] AS d,
    list_inner_product(part::DOUBLE[], part::DOUBLE[]) AS cc
  FROM parts QUALIFY e < 256),{steps}
coded AS (
  SELECT k.vec_id, any_value(k.label) AS label, string_agg(printf('%02x', a.best % 256), '' ORDER BY p.p) AS code, sum(a.best // 256)::BIGINT AS error
  FROM kept k JOIN parts p ON k.vec_id = p.vec_id JOIN a{rounds} a ON a.p = p.p AND a.part = p.part GROUP BY k.vec_id),
books AS (
  SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM coded, books"""


ORACLE["op11_vector_codes"] = _codes_sql()


@query
def op12_filter_interactions(spark, folder):
    return audit.interactions(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


ORACLE["op12_filter_interactions"] = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
marked AS (
  SELECT doc_id, part, [
    len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
    regexp_matches(text, '[#$%&*|]'),
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails
  FROM words),
docs AS (
  SELECT m.*, coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic FROM marked m LEFT JOIN labels l USING (doc_id)),
orders AS (
  SELECT a || b || c || d || e AS filter_order, list_transform([a, b, c, d, e], lambda x: ascii(x) - 64) AS o
  FROM (SELECT chr(k::INT) AS a FROM range(65, 70) r(k)), (SELECT chr(k::INT) AS b FROM range(65, 70) r(k)), (SELECT chr(k::INT) AS c FROM range(65, 70) r(k)),
    (SELECT chr(k::INT) AS d FROM range(65, 70) r(k)), (SELECT chr(k::INT) AS e FROM range(65, 70) r(k))
  WHERE len(list_distinct([a, b, c, d, e])) = 5),
groups AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM docs GROUP BY ALL),
steps AS (
  SELECT part, filter_order, step::INT AS step, o[step] AS f, n, good, toxic,
    fails[o[step]] AS failing, list_bool_or(list_transform(o[1:step - 1], lambda k: fails[k])) IS TRUE AS gone,
    len(list_filter(fails, lambda x: x)) = 1 AS alone
  FROM groups, orders, range(1, 6) AS s(step)),
summed AS (
  SELECT part, filter_order, step, f,
    coalesce(sum(n) FILTER (NOT gone AND NOT failing), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (NOT gone AND failing), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (gone AND failing), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (failing AND alone), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (NOT gone AND failing), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND failing), 0)::BIGINT AS toxic_lost
  FROM steps GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley
FROM summed"""


@query
def op13_exact_dedup(spark, folder):
    return exact_dedup.deduplicate(read_table(spark, folder, "documents"), shared_dir(spark, "dedup-index"))


ORACLE["op13_exact_dedup"] = r"""
WITH plain AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents),
placed AS (SELECT doc_id, text, min(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size FROM plain)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256 FROM placed"""
