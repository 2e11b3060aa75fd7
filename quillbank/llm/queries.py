"""The operators applied to their whole tables with production parameters, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillbank.llm import (
    chat, decontaminate, exact_dedup, html_content, lexical_search, licenses, mixing, secrets, simhash, spelling, substring_dedup, toxicity, url_filter,
)
from quillbank.llm.frames import table, unpacked


def _with_path(documents: DataFrame) -> DataFrame:
    """Documents have no path; they get one by source and id, in which some stand for the licence files of directories."""
    name = F.when(F.col("doc_id") % 50 == 0, "LICENSE").otherwise(F.format_string("%d.txt", "doc_id"))
    folder = F.when(F.col("doc_id") % 1000 == 0, F.format_string("/%d", F.expr("doc_id div 10000"))).otherwise(
        F.format_string("/%d/%d", F.expr("doc_id div 10000"), F.expr("doc_id div 1000")))
    folder = F.when(F.col("doc_id") % 10000 == 0, "").otherwise(folder)
    return documents.select("doc_id", F.concat("source", folder, F.lit("/"), name).alias("path"), "text")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(_with_path(table(spark, sf_dir, "documents")))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "found.n_words", "found.n_hit",
        F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "found.items").cast("binary"), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"), F.col("found.longest.n_words").alias("longest_match"),
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.with_removal(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "found.n_words", "found.n_removed",
        F.sha2(F.col("found.kept").cast("binary"), 256).alias("kept_sha256"),
    )


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value of a finding is shown by its digest."""
    found = secrets.scan(_with_path(table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id", "line_no", "word_no", "part", F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"), "coverage", "score", "secret",
        secrets.held_out(F.col("doc_id")).alias("held_out"),
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`shards` names the output shard of each draw of a document, as the splitting tree deals them."""
    planned = mixing.allotments(table(spark, sf_dir, "documents"))
    return planned.withColumn("shards", F.array_join(F.col("shards").cast("array<string>"), ","))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_content.with_main_text(table(spark, sf_dir, "pages"), ["page_id", "url"])
    return unpacked(found, ["text"]).select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


#: A conversation of nothing but control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], given.schema)
    return chat.read_back(chat.format_conversations(given.union(added)))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents")))


#: (verdict, host, path)
URL_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"),
]


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.train(url_filter.labelled_urls(spark))
    found = url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES, model, ["page_id"])
    return found.select(F.col("row.page_id").alias("page_id"), "found.host", "found.path", "found.rule", "found.verdict", "found.score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_exact_dedup, op3_toxicity, op4_decontamination, op5_substring_dedup, op6_secret_scan, op7_simhash, op8_mixing,
    op9_html_extraction, op10_chat_formatting, op11_spelling_variants, op12_url_filter, op13_lexical_search,
)}

#: A-Z lower-cased only, as the contracts have it.
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Words of the contracts; RE2 reads bytes above 7F as parts of code points.
_ALNUM = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
#: Terms of a ranked search, with A-Z lower-cased behind the match.
_TERMS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
#: CRC-32 of a text, bit by bit over its bytes.
_CRC = """list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(('0x' || hex(encode({0}))[2 * i - 1:2 * i]) AS BIGINT)
    FOR i IN range(1, octet_length(encode({0})) + 1)]), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
    lambda x, k: xor(x >> 1, (x & 1) * 3988292384)))"""
#: Backslashes behind the first character of what reads as a control string; a bracket of the template.
_ESCAPED = r"regexp_replace(coalesce({0}, ''), '([\[<])(\\*)(/?(?:ROLE\]|INST\]|s>))', '\1\\\2\3', 'g')"

ORACLES = {
    "op2_exact_dedup": f"""
        WITH k AS (SELECT doc_id, sha256({_LOWERED}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM k WINDOW g AS (PARTITION BY text_sha256)""",
    "op4_decontamination": f"""
        WITH b AS (SELECT item_id, {_ALNUM.format(_LOWERED)} AS w FROM benchmark),
        bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[p + 1:p + least(13, len(w))], ' ') AS gram
               FROM (SELECT item_id, w, unnest(range(len(w) - least(13, len(w)) + 1)) AS p FROM b WHERE len(w) > 0)),
        d AS (SELECT doc_id, {_ALNUM.format(_LOWERED)} AS w FROM documents),
        dw AS (SELECT doc_id, n, p, array_to_string(w[p + 1:p + n], ' ') AS gram
               FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS p FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
        h AS (SELECT doc_id, item_id, p, dw.n FROM dw JOIN bw USING (n, gram)),
        hit AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS x FROM h) GROUP BY doc_id),
        found AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM h GROUP BY doc_id),
        starts AS (SELECT doc_id, item_id, p - q AS diagonal, p, n FROM (
            SELECT h.doc_id, h.item_id, h.p, h.n, bp.q FROM h JOIN dw ON dw.doc_id = h.doc_id AND dw.n = h.n AND dw.p = h.p
            JOIN (SELECT item_id, least(13, len(w)) AS n, q, array_to_string(w[q + 1:q + least(13, len(w))], ' ') AS gram
                  FROM (SELECT item_id, w, unnest(range(len(w) - least(13, len(w)) + 1)) AS q FROM b WHERE len(w) > 0)) bp
              ON bp.item_id = h.item_id AND bp.n = dw.n AND bp.gram = dw.gram)),
        runs AS (SELECT *, p - row_number() OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY p) AS run FROM starts),
        longest AS (SELECT doc_id, max(k) AS longest_match FROM (
            SELECT doc_id, count(*) + max(n) - 1 AS k FROM runs GROUP BY doc_id, item_id, diagonal, run) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
               sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
               coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated, CAST(longest_match AS BIGINT) AS longest_match
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN longest USING (doc_id)""",
    "op5_substring_dedup": f"""
        WITH d AS (SELECT doc_id, {_SPACED} AS w FROM documents),
        s AS (SELECT doc_id, p, array_to_string(w[p + 1:p + 13], ' ') AS gram
              FROM (SELECT doc_id, w, unnest(range(len(w) - 12)) AS p FROM d WHERE len(w) >= 13)),
        f AS (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY gram) AS first FROM s),
        gone AS (SELECT DISTINCT doc_id, x FROM (SELECT doc_id, unnest(range(p, p + 13)) AS x FROM f WHERE first < doc_id)),
        n AS (SELECT doc_id, count(*) AS n_removed, list(x) AS xs FROM gone GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(CASE WHEN n_removed IS NULL THEN array_to_string(w, ' ') ELSE kept END) AS kept_sha256
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (
            SELECT doc_id, coalesce(string_agg(word, ' ' ORDER BY x) FILTER (gone.x IS NULL), '') AS kept
            FROM (SELECT d.doc_id, unnest(w) AS word, unnest(range(len(w))) AS x FROM d JOIN n USING (doc_id))
            LEFT JOIN gone USING (doc_id, x) GROUP BY doc_id) USING (doc_id)""",
    "op9_html_extraction": r"""
        WITH a AS (SELECT page_id, url, regexp_extract(html, '<article>(.*)</article>', 1, 's') AS body FROM pages),
        b AS (SELECT page_id, url, unnest(string_split_regex(regexp_replace(regexp_replace(body, '</?b>', '', 'g'), '<br>', ' ', 'g'),
                     '</?(p|h1)>')) AS x, generate_subscripts(string_split_regex(regexp_replace(regexp_replace(body, '</?b>', '', 'g'), '<br>', ' ', 'g'),
                     '</?(p|h1)>'), 1) AS k FROM a),
        c AS (SELECT page_id, url, k, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(x,
              '&quot;', '"'), '&#x27;', chr(39)), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS x FROM b)
        SELECT page_id, url, coalesce(string_agg(x, chr(10) ORDER BY k) FILTER (x <> ''), '') AS text,
               CAST(length(coalesce(string_agg(x, chr(10) ORDER BY k) FILTER (x <> ''), '')) AS BIGINT) AS n_chars
        FROM c GROUP BY page_id, url""",
    "op10_chat_formatting": f"""
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL VALUES (-1, 0, 'user', '{CONTROL_TEXT}'), (-1, 1, 'assistant', '{CONTROL_TEXT}'))
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')})
                        + length('[ROLE][/ROLE]') + CASE WHEN role = 'assistant' THEN length('<s></s>') ELSE length('[INST][/INST]') END)
                    AS BIGINT) AS formatted_chars
        FROM t GROUP BY conv_id""",
    "op11_spelling_variants": rf"""
        WITH RECURSIVE r AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents),
        o AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
              FROM r WHERE length(run) >= 7 GROUP BY 1, 2),
        h AS (SELECT run, n, xor({_CRC.format("CAST(doc_id AS VARCHAR) || ':' || run")}, 4294967295) AS h FROM o),
        d AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
        w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM d WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        x AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
        e AS (SELECT a.word, b.word AS near, b.n AS near_n FROM x a JOIN x b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
              UNION SELECT x.word, w.word, w.n FROM x JOIN w ON x.rest = w.word
              UNION SELECT w.word, x.word, x.n FROM x JOIN w ON x.rest = w.word),
        b AS (SELECT word, count(*) AS n_near, max(near_n) AS most FROM e GROUP BY word),
        f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * n THEN most END AS form_n,
                     CASE WHEN most >= 10 * n THEN (SELECT min(near) FROM e WHERE e.word = w.word AND e.near_n = b.most) END AS form
              FROM w LEFT JOIN b USING (word)),
        c AS (SELECT word, word AS root, 0 AS k FROM f UNION ALL SELECT c.word, f.form, k + 1 FROM c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL)
        SELECT word, form, (SELECT arg_max(root, k) FROM c WHERE c.word = f.word) AS root, n, n_near, form_n FROM f""",
    "op13_lexical_search": f"""
        WITH t AS (SELECT row_number() OVER () AS d, doc_id, {_TERMS.format(_LOWERED)} AS w FROM documents),
        s AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_words FROM t WHERE len(w) > 0),
        p AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(w) AS term FROM t) GROUP BY ALL),
        df AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM p, s GROUP BY term, n_docs),
        q AS (SELECT item_id, term, count(*) AS repeats FROM (SELECT item_id, unnest({_TERMS.format(_LOWERED)}) AS term FROM benchmark) GROUP BY ALL),
        m AS (SELECT d, doc_id, 25 + (75 * len(w) * n_docs) // n_words AS m FROM t, s WHERE len(w) > 0),
        r AS (SELECT item_id, doc_id, d, CAST(sum(repeats * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
              FROM q JOIN p USING (term) JOIN df USING (term) JOIN m USING (d) GROUP BY ALL),
        k AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM r WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10""",
}
