"""Registered queries of the operators, with production parameters, over whole tables; and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.llm.common import read_table, tokenizer_path


def op1_rans_token_file(spark, sf_dir):
    from plumbline.llm.common import scratch
    from plumbline.llm.token_file import read_tokens, write_tokens

    folder = scratch(spark).path("tokens")
    write_tokens(read_table(spark, sf_dir, "documents"), folder, tokenizer_path(), end_id=1)
    return read_tokens(spark, folder, digest_only=True)


def op2_suffix_automaton(spark, sf_dir):
    from plumbline.llm.decontamination import contamination

    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op3_count_min_windows(spark, sf_dir):
    from plumbline.llm.substrings import without_repeats

    return without_repeats(read_table(spark, sf_dir, "documents"), digest_only=True)


def op4_length_histogram(spark, sf_dir):
    from plumbline.llm.lengths import length_histogram

    return length_histogram(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op5_chosen_path_join(spark, sf_dir):
    from plumbline.llm.chosen_path import similar_documents

    return similar_documents(read_table(spark, sf_dir, "documents"))


def op6_crf_personal_data(spark, sf_dir):
    from plumbline.llm.personal_data import personal_data

    return personal_data(read_table(spark, sf_dir, "documents"))


def op7_temperature_mixing(spark, sf_dir):
    from plumbline.llm.mixing import mixed

    taken = mixed(read_table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "source", "alpha", "weight", "epoch", "block", "block_rank")


def op8_stratified_interleaving(spark, sf_dir):
    from plumbline.llm.sharding import interleaved

    return interleaved(read_table(spark, sf_dir, "documents")).drop("rank")


def op9_robust_outliers(spark, sf_dir):
    from plumbline.llm.quality import quality_verdicts

    return quality_verdicts(read_table(spark, sf_dir, "documents"))


def op10_log_bloom(spark, sf_dir):
    from plumbline.llm.scoring import scored

    return scored(read_table(spark, sf_dir, "documents"))


def op11_prefix_parentheses(spark, sf_dir):
    from plumbline.llm.prefix_trie import prefix_trie

    return prefix_trie(read_table(spark, sf_dir, "conversations"))


def op12_event_fold(spark, sf_dir):
    from plumbline.llm.chat import chat_digests, write_chats
    from plumbline.llm.common import scratch

    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    return chat_digests(write_chats(rows.unionByName(planted), scratch(spark)))


def op13_trie_node_pairs(spark, sf_dir):
    from plumbline.llm.spelling import spelling_variants

    return spelling_variants(read_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_rans_token_file,
        op2_suffix_automaton,
        op3_count_min_windows,
        op4_length_histogram,
        op5_chosen_path_join,
        op6_crf_personal_data,
        op7_temperature_mixing,
        op8_stratified_interleaving,
        op9_robust_outliers,
        op10_log_bloom,
        op11_prefix_parentheses,
        op12_event_fold,
        op13_trie_node_pairs,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op2_suffix_automaton": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), i AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, l, array_to_string(w[k + 1:k + l], ' ') AS win
  FROM (SELECT item_id, w, least(10, len(w)) AS l, unnest(range(0, len(w) - least(10, len(w)) + 1)) AS k
        FROM i WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, l, p, array_to_string(w[p + 1:p + l], ' ') AS win
  FROM (SELECT doc_id, w, l, unnest(range(0, len(w) - l + 1)) AS p
        FROM d, (SELECT DISTINCT l FROM iw) WHERE len(w) >= l)
), hits AS (
  SELECT doc_id, p, l, item_id FROM dw JOIN iw USING (l, win)
), per_doc AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + l)) AS q FROM (SELECT DISTINCT doc_id, p, l FROM hits)) GROUP BY doc_id
), per_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN per_doc USING (doc_id) LEFT JOIN per_items USING (doc_id)
""",
    "op3_count_min_windows": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, p, md5(array_to_string(w[p + 1:p + 50], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS p FROM d WHERE len(w) >= 50)
), firsts AS (
  SELECT h, min(doc_id) AS first_doc FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)
), covered AS (
  SELECT DISTINCT doc_id, q
  FROM (SELECT doc_id, unnest(range(p, p + 50)) AS q FROM win JOIN firsts USING (h) WHERE doc_id > first_doc)
), kept AS (
  SELECT doc_id, count(*) FILTER (WHERE c.q IS NOT NULL) AS n_removed,
         string_agg(word, ' ' ORDER BY u.q) FILTER (WHERE c.q IS NULL) AS text
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS q FROM d WHERE len(w) > 0) u
  LEFT JOIN covered c USING (doc_id, q) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op13_trie_node_pairs": r"""
WITH digits AS (
  SELECT list(c ORDER BY i) AS steps FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM (SELECT unnest(range(256)) AS i))
), runs AS (
  SELECT run, doc_id, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS found FROM documents
  ), LATERAL (SELECT translate(found, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run)
  WHERE length(run) >= 5 GROUP BY ALL
), hashed AS (
  SELECT run, times, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
      string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
      lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, CAST(unicode(c) AS BIGINT) - 64] END))),
    lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1])), 4294967295) AS h
  FROM runs, digits
), words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT times, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
), cuts AS (
  SELECT DISTINCT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word != b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS top FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(best.n_near, 0) AS n_near,
         CASE WHEN top >= 2 * w.n THEN (SELECT min(other) FROM near WHERE near.word = w.word AND other_n = top) END AS form,
         CASE WHEN top >= 2 * w.n THEN top END AS form_n
  FROM words w LEFT JOIN best USING (word)
), chains AS (
  WITH RECURSIVE c(word, place) AS (
    SELECT word, word FROM forms
    UNION ALL SELECT c.word, forms.form FROM c JOIN forms ON forms.word = c.place WHERE forms.form IS NOT NULL
  ) SELECT c.word, c.place FROM c JOIN forms ON forms.word = c.place WHERE forms.form IS NULL
)
SELECT word, form, chains.place AS root, n, n_near, form_n FROM forms JOIN chains USING (word)
""",
    "op11_prefix_parentheses": r"""
WITH steps AS (
  SELECT list(c ORDER BY i) AS steps FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM (SELECT unnest(range(256)) AS i))
), own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), heads AS (
  SELECT conv_id, turns, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
           lambda x: CAST(unicode(x) AS BIGINT))), lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1])), 4294967295) % 4 AS h
  FROM own, steps
), made AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns, [])[1:a.h], a.turns[a.h + 1:]) AS turns
  FROM heads a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 20
), members AS (
  SELECT conv_id, len(turns) AS length, d AS depth, md5(CAST(to_json(turns[1:d]) AS VARCHAR)) AS node,
         CASE WHEN d > 0 THEN md5(CAST(to_json(turns[1:d - 1]) AS VARCHAR)) END AS parent,
         CASE WHEN d > 0 THEN len(regexp_extract_all(turns[d].t, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
  FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM made)
), nodes AS (
  SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = length), '')) AS ends_sha256
  FROM members GROUP BY node, depth
), children AS (
  SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY ALL
), above AS (
  SELECT n.node AS below, m.node, m.depth FROM nodes n JOIN members m ON m.conv_id = n.conv_id AND m.depth <= n.depth
), sums AS (
  SELECT above.node, above.depth, CAST(sum(b.saved) AS BIGINT) AS saved_tokens,
         CAST(count(*) FILTER (WHERE c.n_children IS NULL) AS BIGINT) AS n_leaves
  FROM above JOIN nodes b ON b.node = above.below LEFT JOIN children c ON c.node = b.node GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(c.n_children, 0) AS BIGINT) AS n_children,
       s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN children c ON c.node = n.node JOIN sums s ON s.node = n.node
""",
    "op12_event_fold": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, regexp_replace(role, '([<\[])(\\*)(/?(?:s>|INST\]|SYS\]|ROLE\]))', '\1\2\\\3', 'g') AS safe_role,
         regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]|SYS\]|ROLE\]))', '\1\2\\\3', 'g') AS safe
  FROM c
), f AS (
  SELECT *, CASE role WHEN 'user' THEN '[INST] ' || safe || ' [/INST]' WHEN 'system' THEN '[SYS] ' || safe || ' [/SYS]'
                      WHEN 'assistant' THEN safe || '</s>' ELSE '[ROLE] ' || safe_role || ' [/ROLE]' || safe || '</s>' END AS piece
  FROM e
), g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         CAST(sum(length(piece)) AS BIGINT) AS formatted_chars
  FROM f GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars
FROM g
""",
}
