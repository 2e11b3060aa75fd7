"""Question banks derived row by row from the given tables.

Every table row yields one document (a conversation turn pairs with the next
one by an equi-join), so no bank groups rows and none depends on how often a
key occurs.  Faults are text replacements on sound documents.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbank import fixed_values as fv
from quillbank.functions.sql import case, lit
from quillbank.sources.documents import configure

# Value list of an order, as texts; a choice takes its content from here.
ORDER_VALUES = (
    "array(CAST(o_orderkey AS string), CAST(o_custkey AS string), o_orderstatus, "
    "CAST(CAST(round(o_totalprice * 100) AS bigint) AS string), date_format(o_orderdate, 'yyyy-MM-dd'), "
    "o_orderpriority, CAST(year(o_orderdate) AS string), CAST(month(o_orderdate) AS string), "
    "CAST(day(o_orderdate) AS string), CAST(quarter(o_orderdate) AS string), CAST(o_custkey % 97 AS string))"
)
ARABIC_ZERO_TO_NINE = "٠١٢٣٤٥٦٧٨٩"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt evenly to a few tasks for every core, however few row groups they lie in.

    Dealt by their place in the scan, so that neither repeated nor missing keys gather and nothing has to be sorted.
    """
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return rows.withColumn("_place", F.monotonically_increasing_id()).repartition(tasks, "_place").drop("_place")


def orders(spark, sf_dir) -> DataFrame:
    return spread(table(spark, sf_dir, "orders")).selectExpr(
        "o_orderkey AS id", "o_custkey AS k", f"{ORDER_VALUES} AS vals",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS day")


def as_bank(df: DataFrame, *keep: str) -> DataFrame:
    """``path, filename, raw`` for rows with ``id`` and ``raw``."""
    return df.selectExpr("concat('bank/', id, '.json') AS path", "concat(id, '.json') AS filename", "raw", *keep)


def document(parts: str, extra: str = "''") -> str:
    """A sound document around a JSON text of parts; ``extra`` is text for more root keys."""
    return (
        "concat('{\"parts\":[', " + parts + ", '],\"metadata\":{\"id\":', id, ',\"mapped_id\":', id, "
        "',\"language\":\"en\",\"country\":\"us\"},\"language\":\"en\",\"country\":\"us\",\"question_id\":\"', id, "
        "'\",\"subject\":\"Science\",\"subject_id\":\"123456789012\",\"grade\":\"4\",\"grade_id\":\"234567890123\","
        "\"section_id\":\"345678901234\",\"source\":\"human\"', " + extra + ", '}')"
    )


def choice(kind: str, order: str, more: str = "''", content: str = "get(vals, j)", index: str = "j") -> str:
    return (
        "concat('{\"type\":\"', " + kind + ", '\",\"html_content\":\"<p>', " + content +
        ", '</p>\",\"values\":[],\"unit\":null,\"index\":', " + index + ", ',\"fixed_order\":', " + order +
        ", ',\"last_order\":false', " + more + ", '}')"
    )


def part(new_type: str, body: str, n: str = "1") -> str:
    """JSON text of a part; ``body`` is an expression giving its own keys."""
    return (f"concat('{{\"n\":', {n}, ',\"type\":\"', {new_type}, '\",\"stem\":\"<p>Question ', id, "
            f"'</p>\",\"standalone\":true,', {body}, '}}')")


# ---- choice banks over orders: 1 to 11 choices, ties in the display order ----

CHOICE_KINDS = {
    "mcq": "CASE WHEN j = id % n THEN 'key' ELSE 'distractor' END",
    "mrq": "CASE WHEN j < 2 OR j % 3 = id % 3 THEN 'key' ELSE 'distractor' END",
    "opinion": "'distractor'",
    "oq": "'distractor'",
    "matching": "'distractor'",
    "gmrq": "CASE WHEN j DIV 2 = id % 3 THEN 'key' ELSE 'distractor' END",
}
CHOICE_MORE = {
    "oq": "CASE WHEN j % 5 = 4 THEN '' ELSE concat(',\"correct_order\":', 1 + (j * 7 + id) % n) END",
    "matching": "concat(',\"group\":', 1 + j % 2, CASE WHEN j % 7 = 6 THEN '' ELSE "
                "concat(',\"correct_order\":', 1 + CASE WHEN j % 2 = 0 THEN j DIV 2 ELSE (j DIV 2 + id) % 4 END) END)",
    "gmrq": "concat(',\"group\":', 1 + j % 2)",
}


def choice_bank(spark, sf_dir, part_type: str) -> DataFrame:
    """One question per order; the language alternates between English and Arabic."""
    c = choice(CHOICE_KINDS[part_type], "1 + (3 * j + id) % 7", CHOICE_MORE.get(part_type, "''"),
               index="(j * 5 + id) % 11")
    listed = f"array_join(transform(sequence(0, CAST(n AS int) - 1), j -> {c}), ',')"
    direction = "'\"direction\":\"vertical\",'" if part_type == "oq" else "''"
    body = f"concat({direction}, '\"choices\":[', {listed}, ']')"
    df = orders(spark, sf_dir).selectExpr("*", "1 + k % 11 AS n")
    raw = document(part(lit(part_type), body))
    return as_bank(df.selectExpr("*", f"{raw} AS raw"), "id",
                   "CASE WHEN id % 2 = 1 THEN 'ar' ELSE 'en' END AS language_code")


# ---- counting and puzzle over part, input over events ----

def counting_bank(spark, sf_dir) -> DataFrame:
    """Grid and answer from the part's key and size; odd keys write Arabic-Indic digits."""
    digits = f"CASE WHEN id % 2 = 1 THEN translate(p_size, '0123456789', '{ARABIC_ZERO_TO_NINE}') ELSE p_size END"
    body = (f"concat('\"choices\":[],\"answer\":\"', {digits}, '\",\"grid_size\":\"', 1 + p_size % 9, '×', "
            "1 + id % 12, '\"')")
    df = spread(table(spark, sf_dir, "part")).selectExpr(
        "p_partkey AS id", "CAST(p_size AS string) AS p_size")
    return as_bank(df.selectExpr("*", f"{document(part(lit('counting'), body))} AS raw"), "id")


def puzzle_bank(spark, sf_dir) -> DataFrame:
    """Rows times columns pieces per part."""
    piece = ("concat('{\"index\":', j + 1, ',\"fixed_order\":', 1 + (j * 5 + id) % n, ',\"correct_order\":', j + 1, "
             "',\"src\":\"', p_brand, '/', j, '\"}')")
    body = ("concat('\"choices\":[],\"puzzleRows\":\"', 1 + id % 4, '\",\"puzzleColumns\":\"', 1 + p_size % 3, "
            "'\",\"puzzleImage\":\"', p_brand, '\",\"puzzleImageWidth\":\"100\",\"puzzleImageHeight\":\"80\","
            "\"puzzleImageSplited\":[', array_join(transform(sequence(0, CAST(n AS int) - 1), j -> " + piece +
            "), ','), ']')")
    df = spread(table(spark, sf_dir, "part")).selectExpr(
        "p_partkey AS id", "p_size", "p_brand", "(1 + p_partkey % 4) * (1 + p_size % 3) AS n")
    return as_bank(df.selectExpr("*", f"{document(part(lit('puzzle'), body))} AS raw"), "id")


def input_bank(spark, sf_dir) -> DataFrame:
    """The event's value as text; odd users write it in Arabic-Indic digits."""
    text = "CAST(CAST(value AS decimal(12,2)) AS string)"
    digits = (f"CASE WHEN user_id % 2 = 1 THEN translate({text}, '.0123456789', '٫{ARABIC_ZERO_TO_NINE}') "
              f"ELSE {text} END")
    body = (f"concat('\"choices\":[],\"answer\":{{\"value\":\"', {digits}, '\"', "
            "CASE WHEN id % 2 = 0 THEN concat(',\"unit\":\"', event_type, '\"') ELSE '' END, "
            "',\"constrains\":{\"type\":\"decimal\"', "
            "CASE WHEN user_id % 3 = 0 THEN ',\"sign\":\"mustBeExplicit\",\"must_have_exactly_ndp\":2' ELSE '' END, "
            "'}}')")
    df = spread(table(spark, sf_dir, "events")).selectExpr("event_id AS id", "user_id", "event_type", "value")
    return as_bank(df.selectExpr("*", f"{document(part(lit('input_box'), body))} AS raw"), "id")


# ---- text banks: whole texts, written by to_json because they hold anything ----

def text_document(parts: str, answer: str = "CAST(NULL AS string)") -> str:
    """A document whose parts are an array of structs."""
    return (
        f"to_json(named_struct('parts', {parts}, 'metadata', named_struct('id', id, 'mapped_id', id), "
        f"'answer', {answer}, 'language', 'en', 'country', 'us', 'question_id', CAST(id AS string), "
        f"'statement', 'Read and answer.', 'subject', 'Science', 'subject_id', '123456789012', 'grade', '4', "
        f"'grade_id', '234567890123', 'section_id', '345678901234'))"
    )


def gap_bank(spark, sf_dir) -> DataFrame:
    """The document's text with every eleventh word, from the fourth on, cut out.

    The keys stand in reverse order, after one key that belongs nowhere.
    """
    span = "'<span class=\"g\" data-node-variation=\"gap\">...</span>'"
    df = table(spark, sf_dir, "documents").selectExpr("doc_id AS id", "split(text, ' ') AS words")
    df = df.selectExpr(
        "id",
        f"array_join(transform(words, (w, i) -> CASE WHEN i % 11 = 3 THEN {span} ELSE w END), ' ') AS stem",
        "reverse(filter(words, (w, i) -> i % 11 = 3)) AS cut",
    )
    keys = ("concat(array(named_struct('value', 'spare', 'correct_order', CAST(NULL AS int))), "
            "transform(cut, (w, i) -> named_struct('value', w, 'correct_order', size(cut) - i)))")
    parts = (f"array(named_struct('n', 1, 'type', 'gapText', 'stem', stem, 'standalone', true, "
             f"'choices', CAST(array() AS array<int>), 'gap_text_keys', {keys}))")
    return as_bank(df.selectExpr("id", f"{text_document(parts)} AS raw"), "id")


def turns(spark, sf_dir) -> DataFrame:
    """Every turn with the assistant's reply that follows it, if one does."""
    df = table(spark, sf_dir, "conversations")
    asked = df.selectExpr("conv_id", "turn", "text AS question")
    told = df.where("role = 'assistant'").selectExpr("conv_id", "turn - 1 AS turn", "text AS reply")
    return asked.join(told, ["conv_id", "turn"], "left")


def turn_bank(spark, sf_dir, part_type: str) -> DataFrame:
    """Stem from the user, answer from the assistant."""
    guideline = ("transform(sequence(1, 1 + CAST(turn DIV 2 AS int) % 3), g -> named_struct('student_answer', question, "
                 "'mark', CAST(g % 2 AS string), 'comment', concat('note ', g)))")
    own = {
        "frq": "'choices', CAST(array() AS array<int>), 'answer', reply, "
               "'ai', named_struct('ai_template_id', 123456789000 + turn)",
        "string": "'answer', array_compact(array(reply, question)), "
                  f"'ai', named_struct('ai_template_id', 593158513739, 'guidelines', {guideline})",
    }[part_type]
    parts = (f"array(named_struct('n', 1, 'type', '{part_type}', 'stem', question, 'standalone', true, {own}))")
    answer = "concat('  <p>', reply, '</p>\\n')"
    df = turns(spark, sf_dir).selectExpr("*", "conv_id * 1000 + turn AS id")
    return as_bank(df.selectExpr("*", f"{text_document(parts, answer)} AS raw"), "conv_id", "turn")


def escaped(text: str) -> str:
    return f"replace(replace(replace({text}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def line_bank(spark, sf_dir) -> DataFrame:
    """One part per line of the document, and a root answer with a ``<div>`` per line."""
    df = table(spark, sf_dir, "documents").selectExpr("doc_id AS id", "split(text, '\\n') AS lines")
    parts = ("transform(lines, (x, i) -> named_struct('n', i + 1, 'type', 'frq', 'stem', x, 'standalone', true, "
             "'choices', CAST(array() AS array<int>), 'answer', x, "
             "'ai', named_struct('ai_template_id', 123456789000)))")
    answer = (f"concat('<div>', array_join(transform(lines, x -> concat('<div><b>', {escaped('x')}, '</b></div>')), '\\n'), "
              "'</div>')")
    return as_bank(df.selectExpr("id", f"{text_document(parts, answer)} AS raw"), "id")


def html_lines(spark, sf_dir) -> DataFrame:
    """The document's text as HTML paragraphs, every other one with attributes."""
    line = (f"concat(CASE WHEN i % 2 = 0 THEN '<p class=\"c\" id=\"i\">' ELSE '<p>' END, {escaped('x')}, '</p>')")
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).selectExpr(
        "doc_id AS id", f"array_join(transform(split(text, '\\n'), (x, i) -> {line}), '\\n') AS html")


# ---- the mixed bank: every part type, one fault per faulty document ----

def _fixed_choices(kinds, more=("", "", "", "")) -> str:
    """Four choices with contents from the order."""
    cs = [choice(lit(kind), str(j + 1), lit(extra), content=f"get(vals, {j})", index=str(j))
          for j, (kind, extra) in enumerate(zip(kinds, more))]
    return "concat('\"choices\":[', concat_ws(',', " + ", ".join(cs) + "), ']')"


D, K = "distractor", "key"
GAP = '<span data-node-variation=\\"gap\\">_</span>'
MIXED_PARTS = {
    "mcq": _fixed_choices([K, D, D, D]),
    "gmrq": _fixed_choices([K, D, K, D], [',"group":1', ',"group":1', ',"group":2', ',"group":2']),
    "mrq": _fixed_choices([K, K, D, D]),
    "oq": "concat('\"direction\":\"vertical\",', " + _fixed_choices(
        [D] * 4, [f',"correct_order":{n}' for n in (2, 1, 4, 3)]) + ")",
    "opinion": _fixed_choices([D] * 4),
    "matching": _fixed_choices([D] * 4, [f',"group":{g},"correct_order":{n}' for g, n in ((1, 1), (1, 2), (2, 2), (2, 1))]),
    "frq": "concat('\"choices\":[],\"answer\":\"', day, '\",\"ai\":{\"ai_template_id\":123456789013}')",
    "frq_ai": "concat('\"choices\":[],\"answer\":\"', day, '\",\"ai\":{\"ai_template_id\":123456789013}')",
    "gapText": "concat('\"choices\":[],\"gap_text_keys\":[{\"value\":\"', get(vals, 0), '\",\"correct_order\":1},"
               "{\"value\":\"', day, '\"},{\"value\":\"', get(vals, 1), '\",\"correct_order\":2}]')",
    "string": "concat('\"choices\":null,\"answer\":[\"', day, '\"],\"ai\":{\"ai_template_id\":593158513739,"
              "\"guidelines\":[{\"student_answer\":\"', day, '\",\"mark\":\"1\",\"comment\":\"right\"},"
              "{\"student_answer\":\"', get(vals, 0), '\",\"mark\":0,\"comment\":\"wrong\"}]}')",
    "counting": "concat('\"choices\":[],\"answer\":\"', k, '\",\"grid_size\":\"', 1 + id % 9, '×', 1 + k % 9, '\"')",
    "puzzle": "concat('\"choices\":[],\"puzzleRows\":\"2\",\"puzzleColumns\":\"2\",\"puzzleImage\":\"', day, "
              "'\",\"puzzleImageWidth\":\"100\",\"puzzleImageHeight\":\"80\",\"puzzleImageSplited\":[', "
              "array_join(transform(array(1, 2, 3, 4), x -> concat('{\"index\":', x, ',\"fixed_order\":', 5 - x, "
              "',\"correct_order\":', x, ',\"src\":\"', get(vals, x), '\"}')), ','), ']')",
    "input_box": "concat('\"choices\":[],\"answer\":{\"value\":\"', k, '\",\"constrains\":{\"type\":\"integer\"},"
                 "\"unit\":null}')",
}
FAULT_SLOTS = 42
# The slot whose document becomes the only element of an array.
WRAPPED_SLOT = 31
# (part type or *, slot, text to find, text to put, rules it breaks with their number of findings)
FAULTS = [
    ("*", 9, '"source":"human"', '"source":null', {"Q11": 1}),
    ("*", 18, '"metadata":{', '"metadata":null,"x":{', {"X3": 1}),
    ("*", 19, '"language":"', '"language":"x', {"V81": 1}),
    ("*", 20, '"country":"', '"country":"x', {"V82": 1}),
    ("*", 21, '"question_id":"', '"question_id":"x', {"V80b": 1}),
    ("*", 22, '"subject":"', '"subject":"","x":"', {"K1": 1}),
    ("*", 23, '{"parts":', '{"parts"', {"X1": 1}),
    ("*", 24, '"n":1', '"n":2', {"V6": 1}),
    ("*", 25, '"standalone":true', '"alone":true', {"V5": 1}),
    ("*", 26, '"n":1,"type":"', '"n":1,"type":"x-', {"V7": 1}),
    ("*", 27, '"parts":[', '"parts":[],"x":[', {"V1": 1}),
    ("*", 28, '"metadata":{', '"metadata":{},"x":{', {"V3": 1, "V80a": 1}),
    ("*", 29, '"metadata":{', '"parts":[],"metadata":5,"x":{', {"V1": 1, "V80x": 1, "V82x": 1}),
    ("*", 30, ',"language":"en","country":"us"},"language":"en"', '},"parts":[],"metadata":[],"language":""',
     {"V1": 1, "V80x": 1, "V81x": 1, "V82x": 1}),
    ("*", WRAPPED_SLOT, "", "", {"X2": 1}),
    ("*", 32, '"parts":[', '"parts":[null],"x":[', {"X4": 1}),
    ("*", 33, '"source":"human"', '"answer":5,"source":"human"', {"X7": 1}),
    ("*", 34, '"source":"human"', '"answer":"<![x[y]]>","source":"human"', {"V88": 1}),
    ("*", 35, '"subject_id":"', '"subject_id":"","x":"', {"K2": 1}),
    ("*", 36, '"grade":"', '"grade":"","x":"', {"K3": 1}),
    ("*", 37, '"grade_id":"', '"grade_id":"","x":"', {"K4": 1}),
    ("*", 38, '"section_id":"', '"section_id":"","x":"', {"K5": 1}),
    ("*", 39, '"metadata":{"id":', '"metadata":{"id":"","x":', {"K6": 1}),
    # no fault, but a warning each, and the second an answer with a character that is no text
    ("*", 40, '"source":"human"', '"answer":"<div>a</div>","source":"human"', {}),
    ("*", 41, '"source":"human"', '"answer":"<div><div>&#xD800;</div></div>","source":"human"', {}),
    ("mcq", 8, '"stem":"', '"stem":"","x":"', {"V8": 1}),
    ("string", 3, '"student_answer":"', '"student":"', {"V46": 2}),
    ("string", 4, '"mark":', '"marks":', {"V48": 2}),
    ("string", 5, '"mark":"1"', '"mark":1.5', {"V50": 1}),
    ("string", 6, '"comment":', '"comments":', {"V51": 2}),
    ("string", 7, '"comment":"', '"comment":5,"x":"', {"V52": 2}),
    ("puzzle", 5, '"puzzleRows":"2"', '"puzzleRows":" 2"', {"V69": 1}),
    ("puzzle", 6, '"puzzleImage":"', '"puzzleImage":7,"x":"', {"V70": 1}),
    ("puzzle", 7, '"index":1,', '"index":0,', {"V74": 1}),
    ("mcq", 10, '"type":"key"', '"type":"distractor"', {"V18": 1}),
    ("mcq", 11, '"values":[]', '"values":{}', {"V12": 4}),
    ("mcq", 12, '"index":0', '"index":-1', {"V14": 1}),
    ("mcq", 13, '"fixed_order":1', '"fixed_order":0', {"V15": 1}),
    ("mcq", 14, '"unit":null', '"unit":5', {"V13": 4}),
    ("mcq", 15, '"last_order":false', '"last_order":"no"', {"V16": 4}),
    ("mcq", 16, '"type":"key","html_content"', '"type":"key","html"', {"V9": 1, "V11": 1}),
    ("mcq", 17, '"choices":[', '"choices":null,"x":[', {"V17": 1}),
    ("mrq", 10, '"type":"key"', '"type":"distractor"', {"V21": 1}),
    ("mrq", 11, '"type":"distractor"', '"type":"other"', {"V10": 2}),
    ("mrq", 17, '"choices":[', '"choices":[],"x":[', {"V20": 1}),
    ("oq", 10, '"type":"distractor"', '"type":"item"', {"V30": 1}),
    ("oq", 11, '"direction":"vertical"', '"direction":"Vertical"', {"V31": 1}),
    ("oq", 12, '"correct_order":2', '"correct_order":"b"', {"K8": 1}),
    ("oq", 17, '"choices":[', '"choices":7,"x":[', {"V29": 1}),
    ("opinion", 10, '"type":"distractor"', '"type":"key"', {"V54": 1}),
    ("opinion", 17, '"choices":[', '"x":[', {"V53": 1}),
    ("matching", 10, '"group":2', '"group":1', {"V56": 1}),
    ("matching", 11, '"type":"distractor"', '"type":null', {"V57": 1}),
    ("matching", 12, '"group":2', '"group":[2]', {"X9": 1}),
    ("matching", 13, '"group":1', '"group":3', {"Q29": 2}),
    ("matching", 17, '"choices":[', '"choices":"","x":[', {"V55": 1}),
    ("gmrq", 10, '"group":2', '"group":3', {"V61": 1, "V62": 2}),
    ("gmrq", 11, '"type":"key"', '"type":"distractor"', {"V60": 1, "V61": 1}),
    ("gmrq", 12, '"group":1', '"group":2', {"V59": 1, "V60": 1, "V61": 1}),
    ("gmrq", 17, '"choices":[', '"choices":[],"x":[', {"V58": 1}),
    *[(t, slot, find, put, rules) for t in ("frq", "frq_ai") for slot, find, put, rules in (
        (10, '"choices":[]', '"choices":null', {"V22": 1}),
        (11, '"choices":[]', '"choices":[1]', {"V23": 1}),
        (12, '"answer":"', '"answer":"","x":"', {"V24": 1}),
        (13, '"ai":{', '"ai":null,"x":{', {"V25": 1}),
        (14, '"ai_template_id":', '"ai_template_id":"","x":', {"V26": 1, "V27": 1}),
        (15, "123456789013", "12345", {"V28": 1}),
    )],
    ("gapText", 10, '"choices":[]', '"choices":null', {"V32": 1}),
    ("gapText", 11, '"choices":[]', '"choices":[1]', {"V33": 1}),
    ("gapText", 12, '"gap_text_keys":[', '"gap_text_keys":0,"x":[', {"V34": 1}),
    ("gapText", 13, '"value":"', '"text":"', {"V35": 3}),
    ("gapText", 14, '"correct_order":1', '"correct_order":0', {"V36": 1}),
    ("gapText", 15, "data-node-variation", "data-node", {"V37": 1}),
    ("gapText", 16, '"correct_order":2', '"rank":2', {"V39": 1}),
    ("gapText", 17, '"gap_text_keys":[', '"gap_text_keys":[{"value":"a","correct_order":1}],"x":[', {"V38": 1, "V39": 1}),
    ("gapText", 8, '"stem":"', '"stem":7,"x":"', {"X8": 1}),
    ("string", 10, '"choices":null', '"choices":[]', {"V40": 1}),
    ("string", 11, '"answer":["', '"answer":"","x":["', {"V41": 1}),
    ("string", 12, '"answer":["', '"answer":[1,"', {"V42": 1}),
    ("string", 13, "593158513739", "593158513730", {"V43": 1}),
    ("string", 14, '"guidelines":[', '"guidelines":{},"x":[', {"V44": 1}),
    ("string", 15, '"guidelines":[', '"guidelines":[1,', {"V45": 1}),
    ("string", 16, '"student_answer":"', '"student_answer":1,"x":"', {"V47": 2}),
    ("string", 17, '"mark":"1"', '"mark":"2"', {"V49": 1}),
    ("string", 8, '"ai":{', '"ai":null,"x":{', {"X5": 1}),
    ("counting", 10, '"choices":[]', '"choices":{}', {"V63": 1}),
    ("counting", 11, '"choices":[]', '"choices":[{}]', {"V64": 1}),
    ("counting", 12, '"grid_size":"', '"grid_size":"x', {"V66": 1}),
    ("counting", 13, '"answer":"', '"answer":"-', {"V65": 1}),
    ("puzzle", 10, '"choices":[]', '"choices":""', {"V67a": 1}),
    ("puzzle", 11, '"choices":[]', '"choices":[0]', {"V67b": 1}),
    ("puzzle", 12, '"puzzleImage":"', '"puzzleImage":null,"x":"', {"V68": 1}),
    ("puzzle", 13, '"puzzleColumns":"2"', '"puzzleColumns":"two"', {"X6": 1}),
    ("puzzle", 14, '"puzzleImageWidth":"', '"puzzleImageWidth":"w', {"V71": 1}),
    ("puzzle", 15, '"puzzleImageSplited":[', '"puzzleImageSplited":[],"x":[', {"V72": 1}),
    ("puzzle", 16, '"puzzleRows":"2"', '"puzzleRows":3', {"V73": 1}),
    ("puzzle", 17, '"src":"', '"src":"","x":"', {"V75": 4}),
    ("input_box", 10, '"choices":[]', '"choices":1', {"V76a": 1}),
    ("input_box", 11, '"choices":[]', '"choices":[null]', {"V76b": 1}),
    ("input_box", 12, '"answer":{', '"answer":null,"x":{', {"V77a": 1}),
    ("input_box", 13, '"value":"', '"value":7,"x":"', {"V77b": 1}),
    ("input_box", 14, '"constrains":{', '"constrains":{},"x":{', {"V78a": 1}),
    ("input_box", 15, '"type":"integer"', '"type":"currencyValue"', {"V78b": 1}),
    ("input_box", 16, '"unit":null', '"unit":5', {"V79": 1}),
    ("input_box", 17, '"value":"', '"value":"n', {"K8": 1}),
]


def fault_cases():
    """``(type number, slot, find, put, rules)`` with the general faults spread over all types."""
    for part_type, slot, find, put, rules in FAULTS:
        for number, name in enumerate(fv.PART_TYPES):
            if part_type in ("*", name):
                yield number, slot, find, put, rules


def mixed_bank(spark, sf_dir) -> DataFrame:
    """One single-part question per order; type and fault follow from its keys."""
    body = case(*[(f"type_no = {i}", MIXED_PARTS[t]) for i, t in enumerate(fv.PART_TYPES)])
    gaps = lit(f" {GAP} and {GAP}")
    text = (f"concat('{{\"n\":1,\"type\":\"', element_at({_types()}, CAST(type_no AS int) + 1), "
            f"'\",\"stem\":\"<p>Question ', id, CASE WHEN type_no = {fv.PART_TYPES.index('gapText')} THEN {gaps} "
            f"ELSE '' END, '</p>\",\"standalone\":true,', {body}, '}}')")
    df = orders(spark, sf_dir).selectExpr(
        "*", f"id % {len(fv.PART_TYPES)} AS type_no", f"k % {FAULT_SLOTS} AS slot")
    df = df.selectExpr("*", f"{document(text)} AS sound")
    grouped = {}
    for part_type, slot, find, put, _ in FAULTS:
        where = f"slot = {slot}" if part_type == "*" else (
            f"slot = {slot} AND type_no = {fv.PART_TYPES.index(part_type)}")
        grouped.setdefault((find, put), []).append(where)
    # one reference to the sound text: the fault only selects what to replace by what
    find = case(*[(_any(ws), lit(f)) for (f, _), ws in grouped.items()], otherwise="''")
    put = case(*[(_any(ws), lit(p)) for (_, p), ws in grouped.items()], otherwise="''")
    raw = f"CASE WHEN slot = {WRAPPED_SLOT} THEN concat('[', sound, ']') ELSE replace(sound, {find}, {put}) END"
    return as_bank(df.selectExpr("*", f"{raw} AS raw"), "id")


def _any(conditions) -> str:
    return " OR ".join(f"({c})" for c in conditions)


def _types() -> str:
    return "array(" + ", ".join(lit(t) for t in fv.PART_TYPES) + ")"


# ---- several parts in one document ----

def several_bank(spark, sf_dir) -> DataFrame:
    """One to five parts of mixed types per order, with a root answer that explains each.

    Lists of one choice are written bare; the eleventh choice has no label left. The statement is
    absent, null or given. The first explanation holds a reference to a character that is no text
    where the key is divisible by 50.
    """
    one = {
        "counting": "concat('\"choices\":[],\"answer\":\"', k, '\",\"grid_size\":\"', 1 + j, '×2\"')",
        "frq": "concat('\"choices\":[],\"answer\":\"', day, '\",\"ai\":{\"ai_template_id\":123456789013}')",
        "opinion": "concat('\"choices\":[', array_join(transform(sequence(0, CAST(k % 2 AS int) * 10), x -> concat("
                   "'{\"type\":\"distractor\",\"html_content\":\"c', x, '\",\"values\":[],\"unit\":null,\"index\":', x, "
                   "',\"fixed_order\":', x + 1, '}')), ','), ']')",
    }
    body = case(*[(f"(id + j) % 3 = {i}", f"concat('\"type\":\"{t}\",', {b})") for i, (t, b) in enumerate(one.items())])
    part_text = f"concat('{{\"n\":', j + 1, ',\"stem\":\"s', j, '\",\"standalone\":true,', {body}, '}}')"
    parts = f"array_join(transform(sequence(0, CAST(n AS int) - 1), j -> {part_text}), ',')"
    bad = "CASE WHEN id % 50 = 0 AND j = 0 THEN '&#xD800;' ELSE '' END"
    divs = f"array_join(transform(sequence(0, CAST(n AS int) - 1), j -> concat('<div>e', j, {bad}, '</div>')), '')"
    answer = f"CASE WHEN n = 1 THEN '<p>e0</p>' ELSE concat('<div>', {divs}, '</div>') END"
    statement = "element_at(array('', ',\"statement\":null', ',\"statement\":\"Read.\"'), CAST(k % 3 AS int) + 1)"
    raw = document(parts, f"concat(',\"answer\":\"', {answer}, '\"', {statement})")
    df = orders(spark, sf_dir).selectExpr("*", "1 + k % 5 AS n")
    return as_bank(df.selectExpr("*", f"{raw} AS raw"), "id")


# ---- converted documents with faults of the new structure ----

CONVERTED_PARTS = {
    "counting": '"grid":{"rows":2,"columns":3},"correct_answer":5',
    "frq": '"ai_template_id":"123456789012","acceptable_answers":["a"]',
    "gap": '"gap_keys":[{"value":"a","display_order":1},{"value":"b","display_order":2}],"correct_answer":"x a"',
    "input": '"correct_answer":{"value":5,"unit":null,"constraints":{"type":"integer"}}',
    "matching": '"items":{"A":[{"value":"a"}],"B":[{"value":"b"}],"correct_answer":[{"A":"a","B":"b"}]}',
    "mcq": '"choices":[{"label":"A","value":"a","is_correct":true},{"label":"B","value":"b","is_correct":false}],'
           '"correct_answer":{"label":"A","value":"a"}',
    "mrq": '"choices":[{"label":"A"},{"label":"B"}],"correct_answer":[{"label":"A"},{"label":"B"}]',
    "opinion": '"choices":[{"label":"A"},{"label":"B"}]',
    "ordering": '"direction":"vertical","items":[{"value":"a"},{"value":"b"}],"correct_answer":["a","b"]',
    "puzzle": '"rows":"1","columns":"2","pieces":[{"src":"a"},{"src":"b"}],"correct_answer":"i"',
    "string": '"ai_template_id":"593158513739","acceptable_answers":["a","b"]',
    "gmrq": '"items":{"A":{},"B":[]}',
}
CONVERTED_SLOTS = 40
CONVERTED_FAULTS = [
    ("*", 10, '"parent_id":"', '"parent_id":5,"x":"', {"Q3": 1}),
    ("*", 11, '"language_code":"en"', '"language_code":"xx"', {"Q4": 1, "Q5": 1}),
    ("*", 12, '"language":"English"', '"language":"German"', {"Q5": 1}),
    ("*", 13, '"country_code":"us"', '"country_code":"xx"', {"Q6": 1, "Q7": 1}),
    ("*", 14, '"country":"United States"', '"country":"Egypt"', {"Q7": 1}),
    ("*", 15, '"number_of_parts":1', '"number_of_parts":0', {"Q8": 1, "Q14": 1}),
    ("*", 16, '"grade":"4"', '"grade":4', {"Q9": 1}),
    ("*", 17, '"section_id":"', '"section_id":null,"x":"', {"Q10": 1}),
    ("*", 18, '"source":"human"', '"source":["human"]', {"Q11": 1}),
    ("*", 19, '"content":{', '"contents":{', {"Q1": 1, "Q49": 1}),
    ("*", 20, '"parts":[', '"part":[', {"Q12a": 1}),
    ("*", 21, '"parts":[', '"parts":{},"x":[', {"Q12b": 1}),
    ("*", 22, '"parts":[', '"parts":[],"x":[', {"Q12c": 1}),
    ("*", 23, '"content":{', '"content":{"statement":"s",', {"Q13b": 1}),
    ("*", 24, '"number_of_parts":1', '"number_of_parts":2', {"Q13a": 1, "Q14": 1}),
    ("*", 25, '"stem":"', '"stems":"', {"Q15": 1}),
    ("*", 26, '"n":1', '"n":7', {"Q16": 1}),
    ("*", 27, '"stem":"', '"stem":7,"x":"', {"Q17": 1}),
    ("*", 28, '"question_id":"', '"question_id":null,"x":"', {"Q2": 1}),
    ("counting", 30, '"grid":{', '"x":{', {"Q18a": 1}),
    ("counting", 31, '"rows":2,', '', {"Q18b": 1, "Q18c": 1}),
    ("counting", 32, '"columns":3', '"columns":3.5', {"Q18d": 1}),
    ("counting", 33, '"correct_answer":5', '"x":5', {"Q19a": 1}),
    ("counting", 34, '"correct_answer":5', '"correct_answer":"5"', {"Q19b": 1}),
    ("frq", 30, '"acceptable_answers":', '"x":', {"Q20a": 1}),
    ("frq", 31, '["a"]', '"a"', {"Q20b": 1}),
    ("frq", 32, '"ai_template_id":', '"x":', {"Q21a": 1}),
    ("frq", 33, '"ai_template_id":"123456789012"', '"ai_template_id":123456789012', {"Q21b": 1}),
    ("frq", 34, '"ai_template_id":"123456789012"', '"ai_template_id":"1234"', {"Q21c": 1}),
    ("gap", 30, '"gap_keys":', '"x":', {"Q22a": 1}),
    ("gap", 31, '"gap_keys":[', '"gap_keys":{},"x":[', {"Q22b": 1}),
    ("gap", 32, '"display_order":', '"order":', {"Q23": 2}),
    ("gap", 33, '"correct_answer":', '"x":', {"Q24a": 1}),
    ("gap", 34, '"correct_answer":"', '"correct_answer":1,"x":"', {"Q24b": 1}),
    ("input", 30, '"correct_answer":', '"x":', {"Q25": 1}),
    ("input", 31, '"value":5,', '', {"Q26": 1}),
    ("input", 32, '"constraints":', '"x":', {"Q26": 1}),
    ("input", 33, '{"type":"integer"}', '{}', {"Q27": 1}),
    ("matching", 30, '"items":', '"x":', {"Q28": 1}),
    ("matching", 31, '"B":[', '"C":[', {"Q29": 1}),
    ("mcq", 30, '"choices":', '"x":', {"Q33a": 1}),
    ("mcq", 31, '"choices":[', '"choices":{},"x":[', {"Q33b": 1}),
    ("mcq", 32, '"is_correct":', '"x":', {"Q34": 2}),
    ("mcq", 33, '"correct_answer":', '"x":', {"Q35a": 1}),
    ("mcq", 34, '"correct_answer":{"label":"A",', '"correct_answer":{', {"Q35b": 1}),
    ("mrq", 30, '"choices":', '"x":', {"Q36a": 1}),
    ("mrq", 31, '"choices":[', '"choices":{},"x":[', {"Q36b": 1}),
    ("mrq", 32, '"correct_answer":', '"x":', {"Q37a": 1}),
    ("mrq", 33, '"correct_answer":[', '"correct_answer":{},"x":[', {"Q37b": 1}),
    ("opinion", 30, '"choices":', '"x":', {"Q38a": 1}),
    ("opinion", 31, '"choices":[', '"choices":{},"x":[', {"Q38b": 1}),
    ("opinion", 32, '"choices":', '"correct_answer":null,"choices":', {"Q39": 1}),
    ("ordering", 30, '"direction":', '"x":', {"Q42a": 1}),
    ("ordering", 31, '"vertical"', '"up"', {"Q42b": 1}),
    ("ordering", 32, '"items":', '"x":', {"Q43a": 1}),
    ("ordering", 33, '"items":[', '"items":{},"x":[', {"Q43b": 1}),
    ("ordering", 34, '"correct_answer":', '"x":', {"Q44a": 1}),
    ("ordering", 35, '["a","b"]', '"a"', {"Q44b": 1}),
    ("puzzle", 30, '"rows":', '"x":', {"Q45": 1}),
    ("puzzle", 31, '"pieces":', '"x":', {"Q46a": 1}),
    ("puzzle", 32, '"pieces":[', '"pieces":{},"x":[', {"Q46b": 1}),
    ("string", 30, '"ai_template_id":', '"x":', {"Q47a": 1}),
    ("string", 31, '"ai_template_id":"', '"ai_template_id":1,"x":"', {"Q47b": 1}),
    ("string", 32, '"acceptable_answers":', '"x":', {"Q48a": 1}),
    ("string", 33, '["a","b"]', '{"a":"b"}', {"Q48b": 1}),
]


def converted_bank(spark, sf_dir) -> DataFrame:
    """One converted document per order, as another tool might have written it."""
    types = list(CONVERTED_PARTS)
    parts = case(*[(f"type_no = {i}", lit(f'"type":"{t}",{CONVERTED_PARTS[t]}')) for i, t in enumerate(types)])
    sound = ("concat('{\"question_id\":\"', id, '\",\"parent_id\":\"', k, '\",\"language_code\":\"en\",\"language\":\"English\","
             "\"country_code\":\"us\",\"country\":\"United States\",\"subject\":\"s\",\"grade\":\"4\",\"number_of_parts\":1,"
             "\"section_id\":\"1\",\"source\":\"human\",\"content\":{\"parts\":[{\"n\":1,\"stem\":\"q\",', " + parts +
             ", '}]}}')")
    df = orders(spark, sf_dir).selectExpr(
        "*", f"id % {len(types)} AS type_no", f"k % {CONVERTED_SLOTS} AS slot").selectExpr("*", f"{sound} AS sound")
    find, put = [], []
    for part_type, slot, old, new, _ in CONVERTED_FAULTS:
        of_type = "" if part_type == "*" else f" AND type_no = {types.index(part_type)}"
        find.append((f"slot = {slot}{of_type}", lit(old)))
        put.append((f"slot = {slot}{of_type}", lit(new)))
    text = f"replace(sound, {case(*find, otherwise=lit(''))}, {case(*put, otherwise=lit(''))})"
    return df.selectExpr("id", f"{text} AS converted_json")


def converted_fault_cases():
    for part_type, slot, find, put, rules in CONVERTED_FAULTS:
        for number, name in enumerate(CONVERTED_PARTS):
            if part_type in ("*", name):
                yield number, slot, find, put, rules
