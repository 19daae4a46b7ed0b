"""The registered queries of the subpackage, each with its SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.llm import bpe, decontaminate, fill_middle, language, near_duplicates, neighbours, ngram_model, prefix_trie, quality, reputation, secrets, substrings, toxicity
from featureflow.llm.common import fold, stored, table

URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def op1_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every page's url by rules and by its host's reputation."""
    judged = reputation.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _op1_sql(settings: reputation.Settings) -> str:
    def step(name: str, keys: str, parent: str, join: str) -> str:
        """Shares of one level, shrunk towards the parent's."""
        return f"""
{name}_groups AS (SELECT {keys}, sum(n) AS n, sum(bad) AS bad FROM levels GROUP BY ALL),
{name}_m AS (SELECT g.*, p.m FROM {name}_groups g {join} {parent} p {"USING (" + ", ".join(keys.split(", ")[1:]) + ")" if join == "JOIN" else ""}),
{name}_pull AS (SELECT CASE WHEN coalesce(sum(n * (n - 1)), 0) = 0 THEN 1.0 ELSE
    1 / least(0.9999, greatest(0.0001, (sum(pow(bad - n * m, 2) / (m * (1 - m))) - sum(n)) / sum(n * (n - 1)))) - 1 END AS pull
  FROM {name}_m WHERE n > 0 AND m * (1 - m) > 0),
{name}_ab AS (SELECT *, pull * m + bad AS a, pull * (1 - m) + n - bad AS b FROM {name}_m CROSS JOIN {name}_pull),
{name} AS (SELECT {keys}, n, bad, a, b, a / (a + b) AS m FROM {name}_ab)"""

    second = ", ".join(f"'{s}'" for s in settings.second_level)
    order = sorted(URL_RULES, key=lambda r: -len(r[1]))
    fits = lambda r: (
        f"(host = '{r.split('/')[0]}' OR ends_with(host, '.{r.split('/')[0]}')) AND starts_with(path, '{r[r.index('/'):]}')"
    )
    rule = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r}'" for _, r in order) + " END"
    said = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{v}'" for v, r in order) + " END"
    return f"""
WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
urls AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), '{reputation.UPPER}', '{reputation.LOWER}') AS host,
                regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
marks AS (SELECT doc_id AS page_id, max(CASE WHEN quality <= 0 OR toxic > 0 THEN 1 ELSE 0 END) AS bad FROM labels
          WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id),
hosts AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad FROM urls LEFT JOIN marks USING (page_id) GROUP BY host),
names AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name FROM hosts),
parts AS (SELECT *, string_split(name, '.') AS ls FROM names),
deep AS (SELECT *, CASE WHEN array_to_string(ls[-2:], '.') IN ({second}) THEN 2 ELSE 1 END AS depth FROM parts),
known AS (SELECT *, regexp_matches(name, '^[0-9.]*$|^\\[') OR len(ls) <= depth AS alone FROM deep),
levels AS (SELECT host, n, bad, CASE WHEN alone THEN name ELSE array_to_string(ls[-(depth + 1):], '.') END AS domain,
                  CASE WHEN alone THEN '' ELSE array_to_string(ls[-depth:], '.') END AS suffix FROM known),
total AS (SELECT (sum(bad) + 1.0) / (sum(n) + 2.0) AS m FROM levels),{step("suffixes", "suffix", "total", "CROSS JOIN")},{step("domains", "domain, suffix", "suffixes", "JOIN")},{step("shares", "host, domain, suffix", "domains", "JOIN")},
verdicts AS (SELECT host, CASE WHEN m - {settings.deviations} * sqrt(m * (1 - m) / (a + b + 1)) > {settings.tolerated}
                               THEN 'block' ELSE 'allow' END AS own FROM shares)
SELECT page_id, host, path, {rule} AS rule, coalesce({said}, own) AS verdict FROM urls JOIN verdicts USING (host)
"""


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document; learn from the labelled ones of four folds out of five."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), train=~held_out)
    scored = toxicity.score(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", "held_out", "score", predicted)


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document by the model of nine folds out of ten, and by single tokens."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 10) == 0
    model, counts = ngram_model.fit(docs, train=~held_out)
    scored = ngram_model.score(docs.select("doc_id", "text", held_out.alias("held_out")), model, counts)
    tokens = F.lit(model.tokens).cast("long").alias("train_tokens")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", tokens, "base_score", "score")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict the language of every document; learn from two folds out of three."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = language.fit(docs, train=~held_out)
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    return language.identify(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in passages of benchmark items."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("digest", "hits")


OP5_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
n AS (SELECT item_id, ws, least(10, len(ws)) AS size FROM i WHERE len(ws) > 0),
iw AS (SELECT DISTINCT item_id, size, array_to_string(ws[a:a + size - 1], ' ') AS k
       FROM n, unnest(range(1, len(ws) - size + 2)) AS t(a)),
sizes AS (SELECT DISTINCT size FROM iw),
dw AS (SELECT doc_id, size, a, array_to_string(ws[a:a + size - 1], ' ') AS k
       FROM d, sizes, unnest(range(1, len(ws) - size + 2)) AS t(a)),
m AS (SELECT doc_id, size, a, item_id FROM dw JOIN iw USING (size, k)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM m, unnest(range(a, a + size)) AS u(p) GROUP BY doc_id),
met AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
               string_agg(DISTINCT item_id::varchar, ',' ORDER BY item_id::varchar) AS ids FROM m GROUP BY doc_id)
SELECT doc_id, len(ws)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN met USING (doc_id)
"""


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every vector whose id is divisible by 50."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(rows, rows.where(F.col("vec_id") % 50 == 0))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates of every document."""
    found = near_duplicates.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document and decode it again: number of tokens and digests of both."""
    vocabulary = bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    return bpe.digest_query(table(spark, sf_dir, "documents"), vocabulary)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, by patterns and by entropy."""
    found = secrets.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[c.alias(name) for name, c in secrets.summary(found).items()])


def _op9_sql(settings: secrets.Settings) -> str:
    quoted = lambda text: "'" + text.replace("'", "''") + "'"

    def runs(kind: int, pattern: str, keep: str) -> str:
        """Places of the matches: the text before the k-th is what the pieces and matches before it hold."""
        return f"""
  SELECT doc_id, {kind} AS kind, start, start + len(m) AS end, m FROM (
    SELECT doc_id, m, k, v,
           (list_sum([len(x) for x in gaps[1:k]]) + coalesce(list_sum([len(x) for x in ms[1:k - 1]]), 0))::int AS start
    FROM (SELECT doc_id, ms, gaps, unnest(ms) AS m, unnest(vs) AS v, unnest(range(1, len(ms) + 1)) AS k
          FROM (SELECT doc_id, regexp_extract_all(t, {quoted(pattern)}) AS ms,
                       regexp_extract_all(t, {quoted(pattern)}, {2 if kind == 0 else 0}) AS vs,
                       string_split_regex(t, {quoted(pattern)}) AS gaps FROM d))
  ) WHERE {keep}"""

    classes = " OR ".join(f"(regexp_full_match(win, '({c})+') AND entropy >= {least})" for c, least in settings.classes)
    allowed = "|".join(settings.allowed)
    w = settings.window
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS ({runs(0, secrets.ASSIGN, f"len(v) >= {secrets.ASSIGN_LEAST}")}
  UNION ALL {runs(1, secrets.ACCESS, "true")}
  UNION ALL {runs(2, secrets.HEX, "true")}),
candidates AS ({runs(3, settings.candidate, "true")}),
windows AS (SELECT doc_id, start, i, substr(m, i + 1, {w}) AS win FROM candidates, unnest(range(0, len(m) - {w} + 1)) AS u(i)
            WHERE regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]') AND NOT regexp_full_match(m, {quoted(allowed)})),
counts AS (SELECT doc_id, start, i, win, c, count(*) AS n FROM windows, unnest(string_split(win, '')) AS u(c) GROUP BY ALL),
judged AS (SELECT doc_id, start, i, win, round(log2({w}) - sum(n * log2(n)) / {w}, 9) AS entropy FROM counts GROUP BY ALL),
entropy AS (SELECT doc_id, 3 AS kind, start + min(i) AS s, start + max(i) + {w} AS e FROM judged WHERE {classes} GROUP BY doc_id, start),
spans AS (SELECT doc_id, kind, start AS s, "end" AS e FROM base UNION ALL SELECT doc_id, kind, s, e FROM entropy),
named AS (SELECT doc_id, kind, s, e, ['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || s || ':' || e AS one FROM spans),
found AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
                 count(*) FILTER (kind = 2) AS n_hex, string_agg(one, ',' ORDER BY s, kind, e) FILTER (kind < 3) AS base,
                 string_agg(one, ',' ORDER BY s, kind, e) AS spans FROM named GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0)::bigint AS n_assign, coalesce(n_access, 0)::bigint AS n_access,
       coalesce(n_hex, 0)::bigint AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN found USING (doc_id)
"""


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that documents share with others, one row per occurrence."""
    return substrings.passages(substrings.repeats(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document's quality; learn from the labelled ones of three folds out of four."""
    held_out = fold(F.col("doc_id"), 4) == 2
    docs = quality.with_statistics(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    docs = stored(docs, "document-statistics")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), train=~held_out)
    predicted = (F.col("score") >= 0.7).cast("int").alias("predicted")
    return quality.score(docs.withColumn("held_out", held_out), model).select("doc_id", "held_out", "score", predicted)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    turns = prefix_trie.sequences(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.rebuilt(stored(turns, "conversation-turns"))).drop("x", "y")


OP12_SQL = """
WITH crc AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
             FROM range(256) r(i)),
turns AS (SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS s
          FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (SELECT turns.*, conv_id - conv_id % 5 AS source,
                 xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
                                 lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::bigint) % 9 AS h FROM turns, crc),
made AS (SELECT a.conv_id, list_concat(coalesce(b.s, [])[1:a.h], a.s[a.h + 1:]) AS s FROM heads a LEFT JOIN turns b ON b.conv_id = a.source),
prefixes AS (SELECT conv_id, len(s) AS size, d AS depth, s[1:d] AS p FROM made, unnest(range(0, len(s) + 1)) AS u(d)),
nodes AS (SELECT depth, p, min(conv_id) AS conv_id, count(*) AS n_convs,
                 (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE strlen(p[depth].text) END AS saved,
                 string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (size = depth) AS ends FROM prefixes GROUP BY depth, p),
kids AS (SELECT depth - 1 AS depth, p[1:depth - 1] AS p, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
known AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (depth, p)),
sums AS (SELECT a AS depth, p[1:a] AS p, sum(saved)::bigint AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
         FROM known, unnest(range(0, depth + 1)) AS u(a) GROUP BY ALL)
SELECT k.conv_id, k.depth, up.conv_id AS parent_conv_id, k.n_convs, k.n_children, s.n_leaves, s.saved_tokens, sha256(coalesce(k.ends, '')) AS ends_sha256
FROM known k JOIN sums s USING (depth, p) LEFT JOIN nodes up ON up.depth = k.depth - 1 AND up.p = k.p[1:k.depth - 1]
"""


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at two ranks: sizes, form, and digests of output and restored text."""
    return fill_middle.digests(table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::varchar, '')) AS x FROM documents),
h AS (SELECT doc_id, t, length(t) AS n, ('0x' || x[1:8])::bigint AS h1, ('0x' || x[9:16])::bigint AS h2,
             ('0x' || x[17:24])::bigint AS h3, ('0x' || x[25:32])::bigint AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                   ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

QUERIES = {
    "op1_reputation": (op1_reputation, _op1_sql(reputation.Settings())),
    "op2_toxicity": (op2_toxicity, None),
    "op3_language_model": (op3_language_model, None),
    "op4_language": (op4_language, None),
    "op5_decontamination": (op5_decontamination, OP5_SQL),
    "op6_neighbours": (op6_neighbours, None),
    "op7_near_duplicates": (op7_near_duplicates, None),
    "op8_bpe": (op8_bpe, None),
    "op9_secrets": (op9_secrets, _op9_sql(secrets.Settings())),
    "op10_substrings": (op10_substrings, None),
    "op11_quality": (op11_quality, None),
    "op12_conversation_trie": (op12_conversation_trie, OP12_SQL),
    "op13_fill_in_middle": (op13_fill_in_middle, OP13_SQL),
}
