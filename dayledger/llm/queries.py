"""One query per operator over whole tables, with the parameters of production."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm import (
    conversations,
    decontaminate,
    exact_dedup,
    html_extract,
    language_id,
    line_dedup,
    lm_scoring,
    merkle,
    sentencepiece_scan,
    simhash,
    substring_dedup,
    token_store,
    toxicity,
)
from dayledger.llm.common import ascii_lower, fold, new_folder, table, text_of


def op1_token_output(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids written in id order and read back: position, size and checksum."""
    path = new_folder(spark, "tokens")
    token_store.write_tokens(
        table(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1
    )
    read = token_store.read_tokens(spark, path)
    return token_store.with_crc(read).withColumn("n_tokens", F.col("n_tokens").cast("bigint"))


def op2_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of near-duplicate texts over fingerprints of 3-word shingles."""
    return simhash.near_duplicates(table(spark, folder, "documents"), shingle=3, max_bits=2).drop("row_hash")


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every text, learned from the rows that are not held out."""
    docs = table(spark, folder, "documents").withColumn("held_out", fold("doc_id", 4, 2))
    net = language_id.fit(docs.where(~F.col("held_out")))
    rows = docs.select("doc_id", "held_out", "text")
    return language_id.predict(rows, net).drop("text")


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of equal texts; the digest of texts that needed no full hash for the
    grouping is added here, from the same normalised text."""
    docs = table(spark, folder, "documents")
    found = exact_dedup.exact_dedup(docs)
    digests = exact_dedup.sketches(docs, exact_dedup.full_hash(text_of()).alias("digest"))
    alone = found.where("text_sha256 is null").drop("text_sha256")
    return (
        alone.join(digests, list(exact_dedup.SKETCH))
        .withColumnRenamed("digest", "text_sha256")
        .unionByName(found.where("text_sha256 is not null"))
        .drop(*exact_dedup.SKETCH)
    )


OP4_SQL = f"""
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{"ABCDEFGHIJKLMNOPQRSTUVWXYZ"}',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document left after windows of earlier documents are gone."""
    found = substring_dedup.substring_dedup(table(spark, folder, "documents"), window=13)
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (
  SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS seq
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d)),
least AS (SELECT seq, min(doc_id) AS least FROM starts GROUP BY seq),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS k
  FROM starts JOIN least USING (seq) WHERE least < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS k FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS kept, count(*) AS n_kept
  FROM words ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of every text, and whether their decoding gives the text again."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return sentencepiece_scan.round_trips(docs, model).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        F.xxhash64("ids").alias("ids_hash"),
        "round_trip",
    )


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of every document that repeat an earlier line but for one word."""
    found = line_dedup.mark_lines(table(spark, folder, "documents"), min_words=10)
    return found.select(
        F.col("rest.doc_id").alias("doc_id"),
        "n_lines",
        F.size("dropped").cast("bigint").alias("n_dropped"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


OP7_SQL = r"""
WITH l AS (
  SELECT doc_id, n, line, regexp_extract_all(line, '[^ 	-
]+') AS w, doc_id * 1000000 + n AS place
  FROM (SELECT doc_id, unnest(lines) AS line, unnest(generate_series(0, len(lines) - 1)) AS n
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
f AS (
  SELECT array_to_string(w, ' ') AS whole, any_value(w) AS w, min(place) AS place
  FROM l WHERE len(w) > 0 GROUP BY 1),
keys AS (
  SELECT whole, whole AS key, -1 AS i, place FROM f WHERE len(w) >= 9
  UNION ALL
  SELECT whole, array_to_string(list_concat(w[1 : i], w[i + 2 :]), ' ') AS key, i, place
  FROM (SELECT whole, w, place, unnest(generate_series(0, len(w) - 1)) AS i FROM f WHERE len(w) >= 10)),
of_key AS (
  SELECT key, min(place) FILTER (i = -1) AS whole_place, min(place) FILTER (i >= 0) AS variant_place
  FROM keys GROUP BY key),
of_place AS (SELECT key, i, min(place) AS same_place FROM keys WHERE i >= 0 GROUP BY key, i),
near AS (
  SELECT DISTINCT whole FROM keys JOIN of_key USING (key) LEFT JOIN of_place USING (key, i)
  WHERE (i = -1 AND variant_place < place) OR (i >= 0 AND (whole_place < place OR same_place < place))),
judged AS (
  SELECT doc_id, n, line, len(l.w) > 0 AND (l.place > f.place OR near.whole IS NOT NULL) AS gone
  FROM l LEFT JOIN f ON array_to_string(l.w, ' ') = f.whole LEFT JOIN near ON near.whole = f.whole)
SELECT d.doc_id, CASE WHEN coalesce(text, '') = '' THEN 0 ELSE count(*) END AS n_lines,
       count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM documents d JOIN judged USING (doc_id) GROUP BY d.doc_id, text
"""


def op8_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Log-probability of every text, by unigrams and by the mixed model."""
    docs = table(spark, folder, "documents").select("doc_id", "text", (~fold("doc_id", 7, 2)).alias("learned"))
    return lm_scoring.score(docs, "learned").withColumn("held_out", ~F.col("learned")).drop("learned")


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every text, learned from the labelled rows not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text", fold("doc_id", 3, 1).alias("held_out"))
    labels = table(spark, folder, "labels").where("toxic is not null").select("doc_id", "toxic")
    net = toxicity.fit(docs.where(~F.col("held_out")), labels)
    return toxicity.score(docs, net).drop("text")


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that lie in windows of benchmark items."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_items(docs, table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        decontaminate.n_hit().alias("n_hit"),
        F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


OP10_SQL = r"""
WITH low AS (SELECT 'abcdefghijklmnopqrstuvwxyz' AS l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS u),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), u, l),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents, low),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), u, l),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark, low),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS seq
  FROM (SELECT item_id, w, least(len(w), 13) AS n,
               unnest(generate_series(1, len(w) - least(len(w), 13) + 1)) AS i
        FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
starts AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS seq
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes)),
hits AS (SELECT doc_id, starts.n, i, item_id FROM starts JOIN windows USING (n, seq)),
hit_words AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


def op11_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page, by the templates of its host."""
    found = html_extract.extract(table(spark, folder, "pages"))
    return found.select("rest.page_id", "rest.url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults of every damaged conversation, and the cheapest edits that mend it."""
    return conversations.repair(conversations.damage(table(spark, folder, "conversations")))


#: crc32 of an ASCII text, byte by byte: the polynomial is its fixed value.
CRC32_SQL = """xor(list_reduce(
    list_concat([4294967295::UBIGINT], list_transform(string_split({}, ''), lambda x: ord(x)::UBIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)::UBIGINT[]),
      lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)),
    4294967295::UBIGINT)"""


def _edits_sql(state: int) -> str:
    """The cheapest of the edits of a row, least letter first, then insertions."""
    following = conversations.NEXT[state]
    role = conversations.ROLE[following]
    kept = {role: then for (s, role), then in conversations.KEPT.items() if s == state}
    keep = " ".join(
        f"WHEN class = '{'sua'[c]}' THEN {{'c': late + s{then}.c, 'a': 'K' || s{then}.a, 'r': line || s{then}.r}}"
        for c, then in kept.items()
    )
    return f"""list_sort([
      {{'c': 4 + s{state}.c, 'a': 'D' || s{state}.a, 'r': s{state}.r}},
      CASE WHEN must THEN NULL ELSE {{'c': 3 + late + s{following}.c, 'a': 'R' || s{following}.a,
                                     'r': chr(10) || '{role}:' || text || s{following}.r}} END,
      CASE WHEN must THEN NULL {keep} END])[1] AS b{state}"""


def _insert_sql(state: int) -> str:
    one = conversations.NEXT[state]
    two = conversations.NEXT[one]
    first, second = (f"chr(10) || '{conversations.ROLE[q]}:'" for q in (one, two))
    return f"""list_sort([b{state},
      {{'c': 3 + b{one}.c, 'a': 'I' || b{one}.a, 'r': {first} || b{one}.r}},
      {{'c': 6 + b{two}.c, 'a': 'II' || b{two}.a, 'r': {first} || {second} || b{two}.r}}])[1] AS s{state}"""


OP12_SQL = rf"""
WITH RECURSIVE f AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {CRC32_SQL.format("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")}
           % 20 AS fault
  FROM conversations),
d AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy FROM f WHERE fault <> 0)),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM d),
r AS (
  SELECT *, substr(role, 1, 1) AS class, chr(10) || role || ':' || text AS line,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS earlier,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' END AS kind
  FROM o),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (kind = 'blank') AS blank, count(*) FILTER (kind = 'duplicate') AS duplicate,
         count(*) FILTER (kind = 'truncated') AS truncated,
         count(*) FILTER (earlier || class NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id),
ends AS (
  SELECT {{'c': 0, 'a': '', 'r': ''}} AS s0,
         {{'c': 6, 'a': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS s1,
         {{'c': 3, 'a': 'I', 'r': chr(10) || 'assistant:'}} AS s2, {{'c': 0, 'a': '', 'r': ''}} AS s3),
dp AS (
  SELECT c.conv_id, CAST(coalesce(max(r.i), 0) AS BIGINT) AS i, any_value(s0) AS s0, any_value(s1) AS s1,
         any_value(s2) AS s2, any_value(s3) AS s3
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM c.conv_id, ends
  GROUP BY c.conv_id
  UNION ALL
  SELECT conv_id, i - 1, {", ".join(_insert_sql(q) for q in range(4))}
  FROM (SELECT dp.conv_id, dp.i, {", ".join(_edits_sql(q) for q in range(4))}
        FROM dp JOIN (SELECT conv_id, i, class, line, text, coalesce(kind IN ('blank', 'duplicate'), false) AS must,
                             CASE WHEN kind = 'truncated' THEN 3 ELSE 0 END AS late FROM r) r
          ON r.i = dp.i AND r.conv_id IS NOT DISTINCT FROM dp.conv_id))
SELECT dp.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(s0.c AS BIGINT) AS cost,
       s0.a AS audit, sha256(substr(s0.r, 2)) AS repaired_sha256
FROM dp LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM dp.conv_id WHERE i = 0
"""


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Proofs of every document in a Merkle tree of languages, folded again after
    tampering with every seventh or so."""
    return merkle.manifest(table(spark, folder, "documents"), fold("doc_id", 7, 0))


OP13_SQL = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, lang, coalesce('=' || lang, '') AS tree, n_chars,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
           || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS tail,
         {CRC32_SQL.format("CAST(doc_id AS VARCHAR)")} % 7 = 0 AS tampered
  FROM documents),
l AS (
  SELECT doc_id, tree, tampered,
         sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
         sha256(head || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) AS changed
  FROM t),
r AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         count(*) OVER (PARTITION BY tree) AS n
  FROM l),
nodes AS (
  SELECT tree, 0 AS level, i, n, leaf AS h FROM r
  UNION ALL
  SELECT tree, level + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM nodes WHERE n > 1 GROUP BY tree, level + 1, i // 2),
subroots AS (
  SELECT tree, h, level, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
upper AS (
  SELECT 0 AS level, i, n, h FROM subroots
  UNION ALL
  SELECT level + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM upper WHERE n > 1 GROUP BY level + 1, i // 2),
steps AS (
  SELECT r.tree, r.i, p.level AS step, s.h AS sibling, s.i < p.i AS before
  FROM r JOIN nodes p ON p.tree = r.tree AND p.n > 1 AND p.i = r.i // (1 << p.level)
  LEFT JOIN nodes s ON s.tree = p.tree AND s.level = p.level AND s.i = xor(p.i, 1)
  UNION ALL
  SELECT r.tree, r.i, b.level + p.level, s.h, s.i < p.i
  FROM r JOIN subroots b USING (tree) JOIN upper p ON p.n > 1 AND p.i = b.i // (1 << p.level)
  LEFT JOIN upper s ON s.level = p.level AND s.i = xor(p.i, 1)),
proofs AS (
  SELECT tree, i, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256,
         list(coalesce(sibling, '') ORDER BY step) AS siblings, list(coalesce(before, false) ORDER BY step) AS befores
  FROM steps GROUP BY tree, i),
folding AS (
  SELECT tree, i, 0 AS step, CASE WHEN tampered THEN changed ELSE leaf END AS h FROM r
  UNION ALL
  SELECT f.tree, f.i, f.step + 1,
         CASE WHEN befores[f.step + 1] THEN sha256(siblings[f.step + 1] || h) ELSE sha256(h || siblings[f.step + 1]) END
  FROM folding f JOIN proofs USING (tree, i) WHERE f.step < len(siblings)),
folded AS (SELECT tree, i, max_by(h, step) AS folded_root FROM folding GROUP BY tree, i)
SELECT r.doc_id, r.leaf, b.h AS subroot, u.h AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
       f.folded_root, f.folded_root = u.h AS verified, r.i AS leaf_rank
FROM r JOIN subroots b USING (tree) JOIN folded f ON f.tree = r.tree AND f.i = r.i
LEFT JOIN proofs p ON p.tree = r.tree AND p.i = r.i
CROSS JOIN (SELECT h FROM upper WHERE n = 1) u
"""


QUERIES = {
    "op1_token_output": op1_token_output,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_language_id": op3_language_id,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_line_dedup": op7_line_dedup,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_toxicity": op9_toxicity,
    "op10_decontamination": op10_decontamination,
    "op11_html_extraction": op11_html_extraction,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES = {
    "op4_exact_dedup": OP4_SQL,
    "op5_substring_dedup": OP5_SQL,
    "op7_line_dedup": OP7_SQL,
    "op10_decontamination": OP10_SQL,
    "op12_conversation_repair": OP12_SQL,
    "op13_merkle_manifest": OP13_SQL,
}
