"""Independent SQL for the named queries, over the given tables only.

Nothing here goes through a question document: each statement derives the
expected result straight from table columns.
"""

from quillbank import fixed_values as fv
from quillbank.plans import banks, file_queries
from quillbank.plans.queries import FLOATS

VALS = (
    "[CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus, "
    "CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d'), "
    "o_orderpriority, CAST(year(o_orderdate) AS VARCHAR), CAST(month(o_orderdate) AS VARCHAR), "
    "CAST(day(o_orderdate) AS VARCHAR), CAST(quarter(o_orderdate) AS VARCHAR), CAST(o_custkey % 97 AS VARCHAR)]"
)
ORDERS = f"SELECT o_orderkey AS id, o_custkey AS k, 1 + o_custkey % 11 AS n, {VALS} AS vals FROM orders"


def _choices(kind: str) -> str:
    return f"""
WITH o AS ({ORDERS}),
c AS (SELECT id, k, n, j, '<p>' || vals[j + 1] || '</p>' AS value, 1 + (3 * j + id) % 7 AS fixed_order,
             (j * 5 + id) % 11 AS ix, {kind} AS is_key, id % 2 = 1 AS arabic
      FROM (SELECT id, k, n, vals, unnest(range(n)) AS j FROM o)),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY fixed_order, j) - 1 AS pos FROM c)"""


def _label(rank: str, latin, arabic) -> str:
    def words(xs):
        return "[" + ", ".join(f"'{x}'" for x in xs) + "]"
    return f"CASE WHEN arabic THEN ({words(arabic)})[{rank} + 1] ELSE ({words(latin)})[{rank} + 1] END"


LABEL = _label("pos", fv.LABELS_LATIN, fv.LABELS_ARABIC)


def _fault_values(cases) -> str:
    rows = [f"({t}, {slot}, '{rule}', {n})" for t, slot, _, _, rules in cases for rule, n in rules.items()]
    return "(VALUES " + ", ".join(rows) + ") AS f(type_no, slot, rule_id, n)"


TYPE_NAMES = "[" + ", ".join(f"'{t}'" for t in fv.PART_TYPES) + "]"
MIXED = f"""
WITH broken AS (
  SELECT o_orderkey AS id, rule_id, n FROM orders
  JOIN {_fault_values(banks.fault_cases())}
    ON o_orderkey % {len(fv.PART_TYPES)} = type_no AND o_custkey % {banks.FAULT_SLOTS} = slot),
staged AS (
  SELECT id, rule_id, n, CASE WHEN rule_id[1] IN ('X', 'K') THEN '{fv.STAGE_CONVERSION}'
    WHEN rule_id[1] = 'Q' THEN '{fv.STAGE_POST}' ELSE '{fv.STAGE_PRE}' END AS error_type FROM broken),
docs AS (
  SELECT o_orderkey AS id, o_custkey % {banks.FAULT_SLOTS} AS slot, coalesce(b.n_errors, 0) AS n_errors,
    CASE WHEN b.first IS NULL THEN '{fv.CONVERTED}' WHEN b.first IN ('X', 'K') THEN '{fv.CONVERSION_FAILED}'
      WHEN b.first = 'Q' THEN '{fv.POST_FAILED}' ELSE '{fv.PRE_FAILED}' END AS outcome
  FROM orders LEFT JOIN (SELECT id, sum(n) AS n_errors, min(rule_id[1]) AS first FROM broken GROUP BY id) b
    ON b.id = o_orderkey)"""
QUESTION_ID = f"CASE slot WHEN 21 THEN 'x' || id WHEN 23 THEN 'unknown' WHEN {banks.WRAPPED_SLOT} THEN 'unknown' ELSE CAST(id AS VARCHAR) END"
WARNED = "slot IN (40, 41)"
REPORTED = "(VALUES " + ", ".join(f"('{r}', '{f}', '{e}')" for r, (f, e) in fv.REPORTED.items()) + ") AS t(rule_id, failed, wanted)"
PLAIN = "(VALUES " + ", ".join(
    "('{}', '{}')".format(r, m.replace("{p}", "1").replace("'", "''"))
    for r, m in fv.MESSAGES.items() if "{" not in m.replace("{p}", "")) + ") AS m(rule_id, message)"



def _each(first: int, last: int, text: str) -> list[str]:
    return [text.replace("#", str(k)) for k in range(first, last + 1)]


# What the mixed bank's faults make the messages say that name a value: rule, slot where it depends on it, and the texts in order; {type}
# and {id} are the document's.
NAMED_MESSAGES = [
    ("V5", None, ["Part 1: Missing required field 'standalone'"]),
    ("V6", None, ["Part 1: Part number 'n' (2) does not match its position"]),
    ("V7", None, ["Part 1: Invalid type 'x-{type}'"]),
    ("V9", None, ["Part 1 (mcq), Choice 1: Missing required field 'html_content'"]),
    ("V10", None, _each(3, 4, "Part 1 (mrq), Choice #: Invalid choice type 'other'")),
    ("V11", None, ["Part 1 (mcq), Choice 1: Invalid or empty 'html_content'"]),
    ("V12", None, _each(1, 4, "Part 1 (mcq), Choice #: 'values' must be an array")),
    ("V13", None, _each(1, 4, "Part 1 (mcq), Choice #: 'unit' must be null or a string")),
    ("V14", None, ["Part 1 (mcq), Choice 1: 'index' must be a non-negative number"]),
    ("V15", None, ["Part 1 (mcq), Choice 1: 'fixed_order' must be a positive number"]),
    ("V16", None, _each(1, 4, "Part 1 (mcq), Choice #: 'last_order' must be a boolean")),
    *[(rule, None, ["Part 1 ({type}): 'choices' must be a non-empty array"]) for rule in ("V17", "V20", "V29", "V53", "V55", "V58")],
    ("V18", None, ["Part 1 (mcq): Must have exactly 1 key choice, found 0"]),
    ("V21", None, ["Part 1 (mrq): Must have at least 2 key choices, found 0"]),
    ("V35", None, _each(0, 2, "Part 1 (gapText): gap_text_key at index # must have a 'value' property")),
    ("V36", None, ["Part 1 (gapText): 'correct_order' at index 0 must be a positive number"]),
    ("V38", None, ["Part 1 (gapText): 'gap_text_keys' found: 1, expected at least: 2"]),
    ("V39", None, ["Part 1 (gapText): 'correct_order' found: 1, expected: 2"]),
    ("V42", None, ["Part 1 (string): answer at index 0 must be a string"]),
    ("V45", None, ["Part 1 (string): guidelines[0] must be an object"]),
    ("V46", None, _each(0, 1, "Part 1 (string): guidelines[#] missing required field 'student_answer'")),
    ("V47", None, _each(0, 1, "Part 1 (string): guidelines[#].'student_answer' must be a string")),
    ("V48", None, _each(0, 1, "Part 1 (string): guidelines[#] missing required field 'mark'")),
    ("V49", None, ["Part 1 (string): guidelines[0].'mark' must be 1, 0, '1', or '0', found: '2'"]),
    ("V50", None, ["Part 1 (string): guidelines[0].'mark' must be a string or integer, found: float"]),
    ("V51", None, _each(0, 1, "Part 1 (string): guidelines[#] missing required field 'comment'")),
    ("V52", None, _each(0, 1, "Part 1 (string): guidelines[#].'comment' must be a string")),
    ("V56", None, ["Part 1 (matching): Must have exactly 2 groups, found 1"]),
    ("V59", None, ["Part 1 (gmrq): Must have exactly 2 groups, found 1"]),
    ("V60", None, ["Part 1 (gmrq): Group 1 must have exactly 1 key choice, found 0"]),
    *[("V61", slot, [f"Part 1 (gmrq): Group 2 must have exactly 1 key choice, found {n}"]) for slot, n in ((10, 0), (11, 0), (12, 2))],
    ("V62", None, _each(3, 4, "Part 1 (gmrq), Choice #: 'group' must be 1 or 2")),
    ("V68", None, ["Part 1 (puzzle): Missing required field 'puzzleImage'"]),
    ("V69", None, ["Part 1 (puzzle): 'puzzleRows' must be a string representing a number"]),
    ("V71", None, ["Part 1 (puzzle): 'puzzleImageWidth' must be a string representing a number"]),
    ("V73", None, ["Part 1 (puzzle): Expected 6 image pieces based on rows and columns, but found 4"]),
    ("V74", None, ["Part 1 (puzzle): Piece at index 0 is missing or has invalid 'index'"]),
    ("V75", None, _each(0, 3, "Part 1 (puzzle): Piece at index # is missing or has invalid 'src'")),
    ("V80b", None, ["ID mismatch: mapped_id={id}, question_id=x{id}, filename={id}"]),
    ("V80x", 29, ["'int' object has no attribute 'get'"]),
    ("V82x", 29, ["'int' object has no attribute 'get'"]),
    *[(rule, 30, ["'list' object has no attribute 'get'"]) for rule in ("V80x", "V81x", "V82x")],
    ("V88", None, ["Error parsing root 'answer' field as HTML: unknown status keyword 'x' in marked section"]),
    ("K8", 12, ["JSONata conversion failed for oq part: sort keys are neither all numbers nor all strings"]),
    ("K8", 17, ["JSONata conversion failed for input_box part: value is not a number"]),
    ("Q29", None, ["Part 1 (matching): 'items.A' is required", "Part 1 (matching): 'items.correct_answer' is required"]),
]
NAMED = "(VALUES " + ", ".join(
    "('{}', {}, {}, '{}')".format(rule, "NULL" if slot is None else slot, k, text.replace("'", "''"))
    for rule, slot, texts in NAMED_MESSAGES for k, text in enumerate(texts)) + ") AS v(rule_id, slot, k, text)"


def _country_value(rank: str) -> str:
    """The normalised valid code of a word of the country bank, or NULL."""
    return f"(['eg', 'us', 'zz', 'sa', 'uk', NULL, NULL, NULL, NULL])[{rank} % 9 + 1]"


COUNTRY_CODES = f"SELECT c_custkey AS id, {_country_value('c_custkey')} AS r, {_country_value('(c_custkey // 9)')} AS m FROM customer"
COUNTRY = """CASE WHEN r = 'eg' OR m = 'eg' THEN 'eg' WHEN r IS NULL THEN m WHEN m IS NULL THEN r
  WHEN r = 'zz' AND m <> 'zz' THEN m ELSE r END"""


def _name(code: str, names: dict) -> str:
    return f"CASE {code} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + " END"


ESC = "replace(replace(replace(x, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
LINES = r"SELECT doc_id AS id, string_split(text, chr(10)) AS lines FROM documents"
TURNS = """SELECT q.conv_id, q.turn, q.text AS question, a.text AS reply FROM conversations q
  LEFT JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 AND a.role = 'assistant'"""
SQUEEZE = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"

GROUPED = _choices("false") + """,
g AS (SELECT id, j, value, ix, j % 2 AS b, j // 2 AS half, k, arabic,
        CASE WHEN j % 7 = 6 THEN NULL WHEN j % 2 = 0 THEN 1 + j // 2 ELSE 1 + (j // 2 + id) % 4 END AS pair
      FROM c),
s AS (SELECT *, row_number() OVER (PARTITION BY id, b ORDER BY ix) - 1 AS pos FROM g)"""

ORACLES = {
    "convert_mcq": _choices("j = id % n") + f"""
SELECT id, pos, {LABEL} AS label, value, is_key AS is_correct,
  max({LABEL}) FILTER (is_key) OVER (PARTITION BY id) AS answer_label,
  max(value) FILTER (is_key) OVER (PARTITION BY id) AS answer_value FROM r""",
    "convert_mrq": _choices("j < 2 OR j % 3 = id % 3") + f"""
SELECT r.id, r.pos, {LABEL} AS label, value, is_key AS is_correct, a.n_answers, a.answers
FROM r JOIN (SELECT id, count(*) AS n_answers, string_agg(value, '|' ORDER BY pos) AS answers
             FROM r WHERE is_key GROUP BY id) a ON a.id = r.id""",
    "convert_opinion": _choices("false") + f" SELECT id, pos, {LABEL} AS label, value FROM r",
    "convert_ordering": _choices("false") + """,
k AS (SELECT *, CASE WHEN j % 5 <> 4 THEN 1 + (j * 7 + id) % n END AS correct_order FROM r),
a AS (SELECT id, list({'pos': pos, 'value': value, 'fixed_order': fixed_order, 'correct_order': correct_order} ORDER BY pos) AS shown,
        list(value ORDER BY correct_order NULLS LAST, j) AS answers FROM k GROUP BY id)
SELECT id, x.pos AS pos, x.value AS value, x.fixed_order AS display_order, x.correct_order AS correct_order,
  answers[x.pos + 1] AS answer, 'vertical' AS direction FROM (SELECT id, answers, unnest(shown) AS x FROM a)""",
    "convert_matching": GROUPED + """,
first_a AS (SELECT id, pair, min(pos) AS pos FROM s WHERE b = 0 AND pair IS NOT NULL GROUP BY id, pair),
first_b AS (SELECT id, pair, min_by(value, pos) AS value FROM s WHERE b = 1 AND pair IS NOT NULL GROUP BY id, pair)
SELECT s.id, CASE b WHEN 0 THEN 'A' ELSE 'B' END AS side,
  CASE b WHEN 0 THEN 'A' ELSE 'B' END || (s.pos + 1) AS label, s.value,
  CASE WHEN b = 1 AND fa.pos IS NOT NULL THEN 'A' || (fa.pos + 1) END AS matches,
  CASE WHEN b = 0 THEN fb.value END AS pair
FROM s LEFT JOIN first_a fa ON fa.id = s.id AND fa.pair = s.pair
LEFT JOIN first_b fb ON fb.id = s.id AND fb.pair = s.pair""",
    "convert_gmrq": GROUPED + f""",
y AS (SELECT *, half = id % 3 AS is_correct,
        CASE WHEN b = 0 THEN {_label('pos', fv.LABELS_LATIN, fv.LABELS_ARABIC)}
             ELSE {_label('pos', fv.LABELS_LATIN_SECOND, fv.LABELS_ARABIC_SECOND)} END AS label FROM s),
a AS (SELECT id, max(value) FILTER (b = 0 AND is_correct) AS answer_a,
        max(value) FILTER (b = 1 AND is_correct) AS answer_b FROM y GROUP BY id)
SELECT y.id, answer_a, answer_b, CASE b WHEN 0 THEN 'A' ELSE 'B' END AS side, pos, label, value, is_correct
FROM y JOIN a ON a.id = y.id""",
    "convert_counting": """SELECT p_partkey AS id, CAST(1 + p_size % 9 AS BIGINT) AS grid_rows,
  1 + p_partkey % 12 AS grid_columns, CAST(p_size AS BIGINT) AS correct_answer,
  '<p>Question ' || p_partkey || '</p>' AS stem FROM part""",
    "convert_puzzle": """
WITH p AS (SELECT p_partkey AS id, p_brand, 1 + p_partkey % 4 AS r, 1 + p_size % 3 AS c FROM part),
x AS (SELECT id, p_brand, r, c, unnest(range(r * c)) AS j FROM p)
SELECT id, row_number() OVER (PARTITION BY id ORDER BY 1 + (j * 5 + id) % (r * c), j) - 1 AS pos,
  1 + (j * 5 + id) % (r * c) AS display_order, j + 1 AS correct_order, p_brand || '/' || j AS src,
  CAST(r AS VARCHAR) AS n_rows, CAST(c AS VARCHAR) AS n_columns, p_brand AS image FROM x""",
    "convert_input": """
SELECT event_id AS id, CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS number,
  CASE WHEN event_id % 2 = 0 THEN event_type END AS unit,
  CASE WHEN user_id % 2 = 1 THEN 'hindi' ELSE 'arabic' END AS number_format, 'decimal' AS type,
  CASE WHEN user_id % 3 = 0 THEN 'mustBeExplicit' ELSE 'canBeExplicitOrImplicit' END AS sign,
  'false' AS allow_leading_zeros, 'true' AS remove_leading_zeros_from_normalized_form,
  'notSet' AS normalize_sign, CASE WHEN user_id % 3 = 0 THEN '2' END AS must_have_exactly_ndp,
  CAST(NULL AS VARCHAR) AS must_have_at_least_nsf FROM events""",
    "convert_gap": """
WITH w AS (SELECT doc_id AS id, string_split(text, ' ') AS words FROM documents),
u AS (SELECT id, unnest(words) AS word, unnest(range(len(words))) AS i FROM w)
SELECT id, string_agg(CASE WHEN i % 11 = 3 THEN ' ' || word ELSE word END, ' ' ORDER BY i) AS correct_answer,
  1 + count(*) FILTER (i % 11 = 3) AS n_keys,
  concat_ws('|', 'spare', string_agg(word, '|' ORDER BY i DESC) FILTER (i % 11 = 3)) AS key_values,
  concat_ws(',', '-', string_agg(CAST((i - 3) // 11 + 1 AS VARCHAR), ',' ORDER BY i DESC) FILTER (i % 11 = 3)) AS key_orders,
  1 + count(*) FILTER (i % 11 = 3) AS last_display_order
FROM u GROUP BY id""",
    "convert_string": f"""
SELECT conv_id, turn, question AS stem, '593158513739' AS ai_template_id, concat_ws('|', reply, question) AS answers,
  1 + (turn // 2) % 3 AS n_guidelines,
  (['1', '1,0', '1,0,1'])[1 + (turn // 2) % 3] AS marks,
  (['note 1', 'note 1,note 2', 'note 1,note 2,note 3'])[1 + (turn // 2) % 3] AS comments
FROM ({TURNS})""",
    "convert_frq": f"""
SELECT conv_id, turn, question AS stem, CAST(123456789000 + turn AS VARCHAR) AS ai_template_id, reply AS answer,
  {SQUEEZE.format("'<p>' || reply || '</p>'")} AS explanation
FROM ({TURNS})""",
    "part_explanation": f"""
WITH l AS ({LINES}), u AS (SELECT id, len(lines) AS n, unnest(lines) AS x, unnest(range(len(lines))) AS i FROM l)
SELECT id, i + 1 AS part_no,
  regexp_replace(CASE WHEN n = 1 THEN '<div><div><b>' || {ESC} || '</b></div></div>'
    ELSE '<div><b>' || {ESC} || '</b></div>' END, '\\s+', ' ', 'g') AS part_text FROM u""".replace("\\\\s", "\\s"),
    "converted_text": """
SELECT p_partkey AS id, '{"question_id":"' || p_partkey || '","parent_id":"' || p_partkey
  || '","language_code":"en","language":"English","country_code":"us","country":"United States","subject":"Science",'
  || '"subject_id":"123456789012","grade":"4","grade_id":"234567890123","number_of_parts":1,"section_id":"345678901234",'
  || '"source":"human","content":{"parts":[{"n":1,"type":"counting","stem":"<p>Question ' || p_partkey
  || '</p>","grid":{"rows":' || (1 + p_size % 9) || ',"columns":' || (1 + p_partkey % 12) || '},"correct_answer":'
  || p_size || ',"explanation":null}]}}' AS converted_json FROM part""",
    "outcome_by_document": MIXED + f" SELECT id, outcome, CAST(n_errors AS BIGINT) AS n_errors, {QUESTION_ID} AS question_id FROM docs",
    "outcome_summary": MIXED + f"""
SELECT count(*) AS total, count(*) FILTER (outcome = '{fv.CONVERTED}') AS success,
  count(*) FILTER (outcome = '{fv.PRE_FAILED}') AS pre_failed,
  count(*) FILTER (outcome = '{fv.CONVERSION_FAILED}') AS conversion_failed,
  count(*) FILTER (outcome = '{fv.POST_FAILED}') AS post_failed,
  count(*) FILTER (outcome <> '{fv.CONVERTED}') AS failed, count(*) FILTER ({WARNED}) AS warnings,
  round(100.0 * count(*) FILTER (outcome = '{fv.CONVERTED}') / count(*), 2) AS success_rate,
  count(*) FILTER (outcome <> '{fv.CONVERTED}') = 0 AS all_converted FROM docs""",
    "success_rate": MIXED + f"""
SELECT ({TYPE_NAMES})[id % 13 + 1] AS part_type, count(*) AS total,
  count(*) FILTER (outcome = '{fv.CONVERTED}') AS success,
  round(100.0 * count(*) FILTER (outcome = '{fv.CONVERTED}') / count(*), 2) AS rate FROM docs GROUP BY 1""",
    "pre_errors_by_rule": MIXED + f"""
SELECT rule_id, CAST(sum(n) AS BIGINT) AS n_errors FROM staged WHERE error_type = '{fv.STAGE_PRE}' GROUP BY 1""",
    "conversion_errors_by_rule": MIXED + f"""
SELECT rule_id, CAST(sum(n) AS BIGINT) AS n_errors FROM staged WHERE error_type = '{fv.STAGE_CONVERSION}' GROUP BY 1""",
    "errors_by_type": MIXED + " SELECT error_type, CAST(sum(n) AS BIGINT) AS n_errors FROM staged GROUP BY 1",
    "error_report": MIXED + f"""
SELECT id || '.json' AS filename, {QUESTION_ID.replace("slot", "e.slot")} AS question_id, error_type, e.rule_id AS rule_id,
  coalesce(m.message, replace(replace(v.text, '{{type}}', ({TYPE_NAMES})[id % 13 + 1]), '{{id}}', CAST(id AS VARCHAR))) AS message,
  coalesce(failed, '') AS failed_field, CASE WHEN e.rule_id = 'K6' THEN 'None' ELSE '' END AS actual_value, coalesce(wanted, '') AS expected_format
FROM (SELECT s.id, d.slot AS slot, rule_id, error_type, unnest(range(s.n)) AS k FROM staged s JOIN docs d ON d.id = s.id) e
LEFT JOIN {NAMED} ON v.rule_id = e.rule_id AND v.k = e.k AND coalesce(v.slot, e.slot) = e.slot
LEFT JOIN {REPORTED} ON t.rule_id = e.rule_id LEFT JOIN {PLAIN} ON m.rule_id = e.rule_id""",
    "warnings_report": MIXED + f"""
SELECT id || '.json' AS filename, {QUESTION_ID} AS question_id, 'V84' AS rule_id,
  'Root ''answer'' field for single-part question must contain a <p> tag, but found <div>' AS message FROM docs WHERE {WARNED}""",
    "choice_limit": """
SELECT o_orderkey AS id, 'V19' AS rule_id, CAST(1 + o_custkey % 11 AS VARCHAR) AS found FROM orders
WHERE o_orderkey % 2 = 0 AND o_custkey % 11 > 3""",
    "migrate_multi_part": f"""
WITH o AS (SELECT o_orderkey AS id, o_custkey AS k, 1 + o_custkey % 5 AS n, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders),
p AS (SELECT *, unnest(range(n)) AS j FROM o),
t AS (SELECT id, n, k, j, '{{"n":' || (j + 1) || ',"type":"' || (['counting', 'frq', 'opinion'])[1 + (id + j) % 3] || '","stem":"s' || j || '",'
    || CASE (id + j) % 3
       WHEN 0 THEN '"grid":{{"rows":' || (1 + j) || ',"columns":2}},"correct_answer":' || k
       WHEN 1 THEN '"ai_template_id":"123456789013","acceptable_answers":["' || day || '"]'
       ELSE '"choices":' || CASE WHEN k % 2 = 0 THEN '{{"label":"A","value":"c0"}}' ELSE
         '[' || array_to_string(list_transform(range(11), lambda x: CASE WHEN x < 10 THEN '{{"label":"' || ({fv.LABELS_LATIN})[x + 1] || '",' ELSE '{{' END
           || '"value":"c' || x || '"}}'), ',') || ']' END END
    || ',"explanation":"' || CASE WHEN n = 1 THEN '<p>e0</p>' ELSE '<div>e' || j || '</div>' END || '"}}' AS part FROM p),
d AS (SELECT id, any_value(n) AS n, any_value(k) AS k, string_agg(part, ',' ORDER BY j) AS parts,
    count(*) FILTER ((id + j) % 3 = 2 AND k % 2 = 0) AS bare FROM t GROUP BY id)
SELECT id, CASE WHEN broken THEN '{fv.CONVERSION_FAILED}' WHEN bare > 0 THEN '{fv.POST_FAILED}' ELSE '{fv.CONVERTED}' END AS outcome,
  CASE WHEN broken THEN 'X10' ELSE array_to_string(list_transform(range(bare), lambda x: 'Q38b'), ',') END AS rules, CASE WHEN n > 1 AND k % 3 < 2 THEN 'V4' ELSE '' END AS warned,
  CASE WHEN NOT broken THEN '{{"question_id":"' || id || '","parent_id":"' || id
  || '","language_code":"en","language":"English","country_code":"us","country":"United States","subject":"Science",'
  || '"subject_id":"123456789012","grade":"4","grade_id":"234567890123","number_of_parts":' || n || ',"section_id":"345678901234",'
  || '"source":"human","content":{{' || CASE WHEN n > 1 THEN '"statement":' || (['""', 'null', '"Read."'])[1 + k % 3] || ',' ELSE '' END
  || '"parts":[' || parts || ']}}}}' END AS converted_json
FROM (SELECT *, id % 50 = 0 AND n > 1 AS broken FROM d)""",
    "post_errors_by_rule": f"""
SELECT rule_id, CAST(sum(n) AS BIGINT) AS n_errors FROM orders
JOIN {_fault_values(banks.converted_fault_cases())}
  ON o_orderkey % {len(banks.CONVERTED_PARTS)} = type_no AND o_custkey % {banks.CONVERTED_SLOTS} = slot GROUP BY 1""",
    "filter_by_type": f"""
SELECT o_orderkey AS id, ({TYPE_NAMES})[o_orderkey % 13 + 1] AS part_types, true AS has_parts FROM orders
WHERE ({TYPE_NAMES})[o_orderkey % 13 + 1] IN ('frq', 'oq', 'puzzle')
  AND o_custkey % {banks.FAULT_SLOTS} NOT IN (23, 26, 27, 29, 30, {banks.WRAPPED_SLOT}, 32)""",
    "answer_checks": """
WITH rules(shape, several, rule_id, found) AS (VALUES
  (0, 1, 'V86', 'p'), (1, 0, 'V83', '2'), (1, 1, 'V85', '2'), (2, 0, 'V84', 'div'), (2, 1, 'V87', '0'),
  (3, 0, 'V83', '0'), (3, 1, 'V85', '0'), (4, 0, 'V84', 'div'), (5, 0, 'V84', 'div'), (5, 1, 'V87', '1'),
  (6, 1, 'V86', 'p'), (7, 0, 'V83', '2'), (7, 1, 'V85', '2'))
SELECT o_orderkey AS id, rule_id, found FROM orders
JOIN rules ON o_orderkey % 9 = shape AND o_custkey % 2 = several
UNION ALL SELECT o_orderkey, 'V4', '' FROM orders WHERE o_custkey % 4 = 3""",
    "country_resolution": f"""
SELECT id, country_code, {_name('country_code', fv.COUNTRIES)} AS country
FROM (SELECT id, {COUNTRY} AS country_code FROM ({COUNTRY_CODES}))""",
    "country_choice_limit": f"SELECT id, coalesce(r = 'eg', false) OR coalesce(m = 'eg', false) AS limited FROM ({COUNTRY_CODES})",
    "language_resolution": f"""
WITH w AS (SELECT c_custkey AS id, c_custkey % 7 AS r, (c_custkey // 7) % 7 AS m FROM customer),
x AS (SELECT id, CASE WHEN r IN (3, 4, 5) THEN m ELSE r END AS used FROM w),
y AS (SELECT id, CASE used WHEN 0 THEN 'en' WHEN 1 THEN 'ar' END AS language_code FROM x)
SELECT id, language_code, {_name('language_code', fv.LANGUAGES)} AS language_name FROM y""",
    "id_consistency": """
WITH w AS (SELECT o_orderkey AS id, o_custkey % 7 AS kind, o_custkey % 5 AS p FROM orders),
x AS (SELECT id, p, CASE WHEN kind < 3 THEN CAST(id AS VARCHAR) WHEN kind = 3 THEN CAST(id + 1 AS VARCHAR)
  WHEN kind = 4 THEN 'None' ELSE '' END AS mapped_id FROM w)
SELECT id, mapped_id, CASE WHEN p <> 0 THEN CAST(id AS VARCHAR) END AS parent_id,
  CASE WHEN mapped_id = '' THEN 'V80a' WHEN mapped_id <> CAST(id AS VARCHAR) THEN 'V80b' END AS rule_id,
  CASE WHEN mapped_id = '' THEN '' WHEN mapped_id <> CAST(id AS VARCHAR) THEN
    'mapped_id=' || mapped_id || ', question_id=' || id || ', filename=' || id END AS found FROM x""",
    "common_metadata": """
SELECT o_orderkey AS id, CAST(o_orderkey AS VARCHAR) AS question_id, CAST(o_custkey AS VARCHAR) AS parent_id,
  'fr' AS language_code, 'French' AS language, CASE WHEN o_orderkey % 2 = 0 THEN 'us' ELSE 'in' END AS country_code,
  CASE WHEN o_orderkey % 2 = 0 THEN 'United States' ELSE 'India' END AS country, o_orderpriority AS subject,
  CAST(o_custkey AS VARCHAR) AS subject_id, (['None', '4', '4', '12345678.5', '123456789012.0', '1e-05'])[o_custkey % 6 + 1] AS grade,
  CASE WHEN o_custkey % 2 = 0 THEN 'True' ELSE CAST(o_orderkey AS VARCHAR) END AS grade_id,
  CAST(2 AS BIGINT) AS number_of_parts, strftime(o_orderdate, '%Y-%m-%d') AS section_id,
  CASE WHEN o_orderkey % 3 = 0 THEN 'human' ELSE 'scan' END AS source FROM orders""",
    "value_tests": f"""
SELECT id, kind IN (0, 1, 2, 3, 4) AS empty, kind IN (0, 1, 3, 4, 5, 6) AS falsy, kind IN (5, 6, 7, 10) AS whole,
  CASE kind WHEN 0 THEN 'None' WHEN 1 THEN '' WHEN 2 THEN '  ' WHEN 3 THEN '[]' WHEN 4 THEN '{{}}' WHEN 5 THEN '0'
    WHEN 6 THEN 'False' WHEN 7 THEN 'True' WHEN 8 THEN '1.0' WHEN 9 THEN '2.5' WHEN 10 THEN CAST(id AS VARCHAR)
    WHEN 11 THEN event_type WHEN 12 THEN '[0]' WHEN 13 THEN replace(props, ' ', '')
    ELSE ([{", ".join(f"'{n}'" for n in FLOATS.values())}])[kind - 13] END AS printed
FROM (SELECT *, event_id AS id, event_id % {14 + len(FLOATS)} AS kind FROM events)""",
    "normalized_text": f"SELECT doc_id, {SQUEEZE.format('text')} AS normalized FROM documents",
    "enrich_first_match": """
WITH f AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS r FROM lineitem),
d AS (SELECT o_orderkey AS id, o_custkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS day,
    o_custkey % 5 <> 0 AS has_id,
    (['', '{"type":"frq"}', '{"type":"frq"},{"type":"frq"}'])[o_custkey % 3 + 1] AS parts FROM orders),
j AS (SELECT d.*, f.* FROM d LEFT JOIN f ON has_id AND l_orderkey = id AND r = 1),
t AS (SELECT *, '{"instance":' || k || ',"parts":[' || parts || '],"metadata":{"note":"' || day || '"'
    || CASE WHEN has_id THEN ',"mapped_id":' || id ELSE '' END || '},"grade":' AS head FROM j)
SELECT id, (['unknown', 'frq', 'multipart'])[k % 3 + 1] AS category,
  CASE WHEN NOT has_id THEN 'no_id' WHEN r IS NULL THEN 'no_match' ELSE 'enriched' END AS status,
  CASE WHEN r IS NULL THEN head || '9}' ELSE head
    || CASE WHEN l_linenumber % 3 = 0 THEN 'null' ELSE '"' || l_linenumber || '"' END
    || ',"answer":"","section_id":"' || l_partkey || '","language":"' || l_returnflag
    || '","subject_id":"123456789012","subject":"' || l_suppkey || '","grade_id":"123456789012","country":"'
    || l_linestatus || '","question_id":"' || id || '"}' END AS enriched_json FROM t""",
    "category_routing": f"""
SELECT category, count(*) AS n_documents FROM (
  SELECT CASE WHEN slot = 27 THEN 'unknown' WHEN slot = 26 THEN 'x-' || t ELSE t END AS category
  FROM (SELECT ({TYPE_NAMES})[o_orderkey % 13 + 1] AS t, o_custkey % {banks.FAULT_SLOTS} AS slot FROM orders)
  WHERE slot NOT IN (18, 23, 29, 30, {banks.WRAPPED_SLOT}, 32)) GROUP BY 1""",
    "strip_p_attrs": f"""
WITH l AS ({LINES}), u AS (SELECT id, unnest(lines) AS x, unnest(range(len(lines))) AS i FROM l)
SELECT id, string_agg('<p>' || {ESC} || '</p>', chr(10) ORDER BY i) AS html FROM u GROUP BY id""",
    "clean_documents": f"""
WITH l AS ({LINES}), u AS (SELECT id, unnest(lines) AS x, unnest(range(len(lines))) AS i FROM l),
h AS (SELECT id, string_agg('<p>' || {ESC} || '</p>', chr(10) ORDER BY i) AS html FROM u GROUP BY id)
SELECT id, id || '.json' AS rel_path, html AS stem, html AS second, id AS n FROM h""",
} | file_queries.ORACLES
ORACLES["enrich_few_matches"] = ORACLES["enrich_first_match"].replace("FROM lineitem)", "FROM lineitem WHERE l_quantity > 48)")
