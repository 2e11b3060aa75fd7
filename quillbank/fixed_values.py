"""Values the results depend on, stated once.

Everything here is a fixed value: code tables, accepted types, labels,
defaults and the texts of the reports.  Nothing in this module computes.
"""

# Language and country codes with their display names.
LANGUAGES = {
    "en": "English",
    "ar": "Arabic",
    "de": "German",
    "fr": "French",
    "es": "Spanish",
    "it": "Italian",
    "pt": "Portuguese",
    "zh": "Chinese",
}
COUNTRIES = {
    "eg": "Egypt",
    "us": "United States",
    "uk": "United Kingdom",
    "sa": "Saudi Arabia",
    "in": "India",
    "zz": "ZZ",
}

# Accepted words.
PART_TYPES = [
    "mcq", "gmrq", "mrq", "frq", "oq", "gapText", "string",
    "opinion", "matching", "counting", "puzzle", "input_box", "frq_ai",
]
DIRECTIONS = ["vertical", "horizontal"]
CHOICE_TYPES = ["key", "distractor"]
CONSTRAINT_TYPES = ["decimal", "integer"]
STRING_TEMPLATE_IDS = ["593158513739"]
MARKS = ["0", "1"]
DEFAULT_SOURCE = "human"
ENRICHED_ID = "123456789012"
EGYPT_CHOICE_LIMIT = 4

# Display labels.
LABELS_LATIN = ["A", "B", "C", "D", "E", "F", "G", "H", "I", "J"]
LABELS_ARABIC = ["أ", "ب", "ج", "د", "ه", "و", "ز", "ح", "ط", "ي"]
LABELS_LATIN_SECOND = ["X", "Y", "Z", "AA", "AB", "AC", "AD", "AE", "AF", "AG"]
LABELS_ARABIC_SECOND = ["س", "ص", "ض", "ط", "ظ", "ع", "غ", "ف", "ق", "ك"]

# Digits of the "hindi" number format and what they stand for.
ARABIC_INDIC = "٠١٢٣٤٥٦٧٨٩٫"
ASCII_DIGITS = "0123456789."

# Patterns.
GRID_SIZE = "(?U)^\\d+×\\d+$"
GAP_MARK = 'data-node-variation="gap"'
GAP_SPAN = '<span[^>]*data-node-variation="gap"[^>]*>[^\\n]*?</span>'

# Numeric-input constraints and their defaults, as JSON text.
CONSTRAINT_DEFAULTS = {
    "allow_leading_zeros": "false",
    "allow_trailing_zeros": "false",
    "sign": '"canBeExplicitOrImplicit"',
    "remove_leading_zeros_from_normalized_form": "true",
    "remove_trailing_zeros_from_normalized_form": "true",
    "add_single_leading_zero_to_normalized_form": "false",
    "remove_trailing_decimal_point_from_normalized_form": "false",
    "normalize_sign": '"notSet"',
    "must_have_no_more_than_nsf": "null",
    "must_have_at_least_nsf": "null",
    "must_have_exactly_nsf": "null",
    "must_have_at_least_ndp": "null",
    "must_have_no_more_than_ndp": "null",
    "must_have_exactly_ndp": "null",
}

# Outcomes, report stages and report column names.
CONVERTED = "CONVERTED"
PRE_FAILED = "PRE_CONVERSION_VALIDATION_FAILED"
CONVERSION_FAILED = "CONVERSION_FAILED"
POST_FAILED = "POST_CONVERSION_VALIDATION_FAILED"
STAGE_PRE = "Pre-Conversion Validation"
STAGE_CONVERSION = "Conversion"
STAGE_POST = "Post-Conversion Validation"
ERROR_COLUMNS = [
    "Filename", "Question ID", "Error Type", "Error Message",
    "Failed Field", "Actual Value", "Expected Format", "Timestamp",
]
WARNING_COLUMNS = ["Filename", "Question ID", "Warning Message", "Timestamp"]

# Report texts by rule.  {p} is the part number, {e} the element
# number as shown to the reader, {t} the part type; the other names are filled
# in by the rule.
MESSAGES = {
    # legacy structure: document
    "V1": "Missing or invalid 'parts' array",
    "V3": "Missing or invalid 'metadata' object",
    "V4": "Multipart questions should have a 'statement' field",
    # legacy structure: part
    "V5": "Part {p}: Missing required field '{field}'",
    "V6": "Part {p}: Part number 'n' ({value}) does not match its position",
    "V7": "Part {p}: Invalid type '{value}'",
    "V8": "Part {p}: Invalid or missing 'stem' field",
    # legacy structure: choice
    "V9": "Part {p} ({t}), Choice {e}: Missing required field '{field}'",
    "V10": "Part {p} ({t}), Choice {e}: Invalid choice type '{value}'",
    "V11": "Part {p} ({t}), Choice {e}: Invalid or empty 'html_content'",
    "V12": "Part {p} ({t}), Choice {e}: 'values' must be an array",
    "V13": "Part {p} ({t}), Choice {e}: 'unit' must be null or a string",
    "V14": "Part {p} ({t}), Choice {e}: 'index' must be a non-negative number",
    "V15": "Part {p} ({t}), Choice {e}: 'fixed_order' must be a positive number",
    "V16": "Part {p} ({t}), Choice {e}: 'last_order' must be a boolean",
    # legacy structure: choice lists (V17, V20, V29, V53, V55, V58)
    "V17": "Part {p} ({t}): 'choices' must be a non-empty array",
    "V18": "Part {p} (mcq): Must have exactly 1 key choice, found {value}",
    "V19": "Part {p} (mcq): Must have at most 4 choices, found {value} as country is Egypt",
    "V20": "Part {p} ({t}): 'choices' must be a non-empty array",
    "V21": "Part {p} (mrq): Must have at least 2 key choices, found {value}",
    "V22": "Part {p} (frq_ai): 'choices' must be an empty array",
    "V23": "Part {p} (frq_ai): 'choices' must be empty for frq_ai",
    "V24": "Part {p} (frq_ai): 'answer' field is required and must be a string",
    "V25": "Part {p} (frq_ai): 'ai' field is required and must be an object",
    "V26": "Part {p} (frq_ai): 'ai.ai_template_id' is required",
    "V27": "Part {p} (frq_ai): 'ai.ai_template_id' is required",
    "V28": "Part {p} (frq_ai): 'ai.ai_template_id' must be exactly 12 digits",
    "V29": "Part {p} ({t}): 'choices' must be a non-empty array",
    "V30": "Part {p} (oq): All choices must have type 'distractor'",
    "V31": "Part {p} (oq): 'direction' must be 'vertical' or 'horizontal'",
    "V32": "Part {p} (gapText): 'choices' must be an empty array",
    "V33": "Part {p} (gapText): 'choices' must be empty for gapText",
    "V34": "Part {p} (gapText): 'gap_text_keys' must be a non-empty array",
    "V35": "Part {p} (gapText): gap_text_key at index {e} must have a 'value' property",
    "V36": "Part {p} (gapText): 'correct_order' at index {e} must be a positive number",
    "V37": "Part {p} (gapText): stem must have at least one gap.",
    "V38": "Part {p} (gapText): 'gap_text_keys' found: {value}, expected at least: {expected}",
    "V39": "Part {p} (gapText): 'correct_order' found: {value}, expected: {expected}",
    "V40": "Part {p} (string): 'choices' must be null",
    "V41": "Part {p} (string): 'answer' must be an array of strings",
    "V42": "Part {p} (string): answer at index {e} must be a string",
    "V43": "Part {p} (string): 'ai_template_id' is not a valid string ai template id.",
    "V44": "Part {p} (string): 'guidelines' must be an array",
    "V45": "Part {p} (string): guidelines[{e}] must be an object",
    "V46": "Part {p} (string): guidelines[{e}] missing required field 'student_answer'",
    "V47": "Part {p} (string): guidelines[{e}].'student_answer' must be a string",
    "V48": "Part {p} (string): guidelines[{e}] missing required field 'mark'",
    "V49": "Part {p} (string): guidelines[{e}].'mark' must be 1, 0, '1', or '0', found: {value}",
    "V50": "Part {p} (string): guidelines[{e}].'mark' must be a string or integer, found: {value}",
    "V51": "Part {p} (string): guidelines[{e}] missing required field 'comment'",
    "V52": "Part {p} (string): guidelines[{e}].'comment' must be a string",
    "V53": "Part {p} ({t}): 'choices' must be a non-empty array",
    "V54": "Part {p} (opinion): All choices must have type 'distractor'",
    "V55": "Part {p} ({t}): 'choices' must be a non-empty array",
    "V56": "Part {p} (matching): Must have exactly 2 groups, found {value}",
    "V57": "Part {p} (matching): All choices must have type 'distractor'",
    "V58": "Part {p} ({t}): 'choices' must be a non-empty array",
    "V59": "Part {p} (gmrq): Must have exactly 2 groups, found {value}",
    "V60": "Part {p} (gmrq): Group 1 must have exactly 1 key choice, found {value}",
    "V61": "Part {p} (gmrq): Group 2 must have exactly 1 key choice, found {value}",
    "V62": "Part {p} (gmrq), Choice {e}: 'group' must be 1 or 2",
    "V63": "Part {p} (counting): 'choices' must be an empty array",
    "V64": "Part {p} (counting): 'choices' must be empty for counting",
    "V65": "Part {p} (counting): 'answer' field must be a string representing a number",
    "V66": "Part {p} (counting): 'grid_size' must be a string in format 'rows×columns'",
    "V67a": "Part {p} (puzzle): 'choices' must be an empty array",
    "V67b": "Part {p} (puzzle): 'choices' must be empty for puzzle",
    "V68": "Part {p} (puzzle): Missing required field '{field}'",
    "V69": "Part {p} (puzzle): '{field}' must be a string representing a number",
    "V70": "Part {p} (puzzle): 'puzzleImage' must be a string URL",
    "V71": "Part {p} (puzzle): '{field}' must be a string representing a number",
    "V72": "Part {p} (puzzle): 'puzzleImageSplited' must be a non-empty array",
    "V73": "Part {p} (puzzle): Expected {expected} image pieces based on rows and columns, but found {value}",
    "V74": "Part {p} (puzzle): Piece at index {e} is missing or has invalid '{field}'",
    "V75": "Part {p} (puzzle): Piece at index {e} is missing or has invalid 'src'",
    "V76a": "Part {p} (input_box): 'choices' must be an empty array",
    "V76b": "Part {p} (input_box): 'choices' must be empty for input_box",
    "V77a": "Part {p} (input_box): 'answer' field must be an object",
    "V77b": "Part {p} (input_box): 'answer.value' must be a string",
    "V78a": "Part {p} (input_box): 'answer.constrains' must be an object",
    "V78b": "Part {p} (input_box): 'constrains.type' must be 'decimal' or 'integer'",
    "V79": "Part {p} (input_box): 'answer.unit' must be a string or undefined",
    # legacy structure: root answer, ids, codes
    "V80a": "Missing metadata.mapped_id",
    "V80b": "ID mismatch: {value}",
    "V80x": "'{value}' object has no attribute 'get'",
    "V81": "No valid language code found",
    "V81x": "'{value}' object has no attribute 'get'",
    "V82": "Invalid country code",
    "V82x": "'{value}' object has no attribute 'get'",
    "V83": "Root 'answer' field for single-part question must contain exactly one <p> tag, but found {value} top-level elements",
    "V84": "Root 'answer' field for single-part question must contain a <p> tag, but found <{value}>",
    "V85": "Root 'answer' field for multipart question must contain exactly one parent <div>, but found {value} top-level elements",
    "V86": "Root 'answer' field for multipart question must contain a parent <div>, but found <{value}>",
    "V87": "Root 'answer' field for multipart question must have {expected} direct child <div>s (one per part), but found {value}",
    "V88": "Error parsing root 'answer' field as HTML: {value}",
    # documents that cannot be processed at all
    "X1": "Unexpected error: Invalid JSON format",
    "X2": "Unexpected error: document is not a JSON object",
    "X3": "Unexpected error: 'metadata' is not a JSON object",
    "X4": "Unexpected error: a part, choice, gap key or puzzle piece is not a JSON object",
    "X5": "Unexpected error: 'ai' of a string part is not a JSON object",
    "X6": "Unexpected error: puzzle rows or columns are not a number",
    "X7": "Unexpected error: root 'answer' is neither empty nor a string",
    "X8": "Unexpected error: stem of a gapText part is neither a string nor an array",
    "X9": "Unexpected error: a choice 'group' is an array or an object",
    "X10": "Unexpected error: root 'answer' holds a character that cannot be written",
    "X11": "Unexpected error: the file cannot be read",
    # conversion
    "K1": "Missing required field 'subject'",
    "K2": "Missing required field 'subject_id'",
    "K3": "Missing required field 'grade'",
    "K4": "Missing required field 'grade_id'",
    "K5": "Missing required field 'section_id'",
    "K6": "Invalid parent_id",
    "K8": "JSONata conversion failed for {t} part: {value}",
    # new structure: root and content
    "Q1": "Missing required root field: '{field}'",
    "Q2": "'question_id' must be a string",
    "Q3": "'parent_id' must be null or a string",
    "Q4": "Invalid language_code: '{value}'",
    "Q5": "Language mismatch: got '{value}', expected '{expected}'",
    "Q6": "Invalid country_code: '{value}'",
    "Q7": "Country mismatch: got '{value}', expected '{expected}'",
    "Q8": "'number_of_parts' must be a positive integer",
    "Q9": "'grade' must be a string",
    "Q10": "'section_id' must be a string",
    "Q11": "'source' must be a string",
    "Q12a": "Content missing 'parts' array",
    "Q12b": "'parts' must be an array",
    "Q12c": "'parts' array cannot be empty",
    "Q13a": "Multi-part questions must have 'statement' in content",
    "Q13b": "Single-part questions should not have 'statement' in content",
    "Q14": "Parts count mismatch: content has {value} parts but number_of_parts is {expected}",
    "Q49": "Missing 'content' object",
    # new structure: part
    "Q15": "Part {p}: Missing required field '{field}'",
    "Q16": "Part {p}: Part number 'n' ({value}) does not match position",
    "Q17": "Part {p}: 'stem' must be a string",
    "Q18a": "Part {p} (counting): Missing 'grid' object",
    "Q18b": "Part {p} (counting): 'grid' must have 'rows' and 'columns'",
    "Q18c": "Part {p} (counting): 'grid.rows' must be an integer",
    "Q18d": "Part {p} (counting): 'grid.columns' must be an integer",
    "Q19a": "Part {p} (counting): Missing 'correct_answer'",
    "Q19b": "Part {p} (counting): 'correct_answer' must be an integer",
    "Q20a": "Part {p} (frq): Missing 'acceptable_answers'",
    "Q20b": "Part {p} (frq): 'acceptable_answers' must be an array",
    "Q21a": "Part {p} (frq): 'ai_template_id' is required",
    "Q21b": "Part {p} (frq): 'ai_template_id' must be a string",
    "Q21c": "Part {p} (frq): 'ai_template_id' must be exactly 12 digits",
    "Q22a": "Part {p} (gap): Missing 'gap_keys'",
    "Q22b": "Part {p} (gap): 'gap_keys' must be an array",
    "Q23": "Part {p} (gap): gap_key {e} missing '{field}'",
    "Q24a": "Part {p} (gap): Missing 'correct_answer'",
    "Q24b": "Part {p} (gap): 'correct_answer' must be a string",
    "Q25": "Part {p} (input): Missing 'correct_answer'",
    "Q26": "Part {p} (input): 'correct_answer.{field}' is required",
    "Q27": "Part {p} (input): 'constraints.type' is required",
    "Q28": "Part {p} (matching): Missing 'items'",
    "Q29": "Part {p} (matching): 'items.{field}' is required",
    "Q33a": "Part {p} (mcq): Missing 'choices'",
    "Q33b": "Part {p} (mcq): 'choices' must be an array",
    "Q34": "Part {p} (mcq): choice {e} missing '{field}'",
    "Q35a": "Part {p} (mcq): Missing 'correct_answer'",
    "Q35b": "Part {p} (mcq): 'correct_answer' must have 'label' and 'value'",
    "Q36a": "Part {p} (mrq): Missing 'choices'",
    "Q36b": "Part {p} (mrq): 'choices' must be an array",
    "Q37a": "Part {p} (mrq): Missing 'correct_answer'",
    "Q37b": "Part {p} (mrq): 'correct_answer' must be an array",
    "Q38a": "Part {p} (opinion): Missing 'choices'",
    "Q38b": "Part {p} (opinion): 'choices' must be an array",
    "Q39": "Part {p} (opinion): Should not have 'correct_answer'",
    "Q42a": "Part {p} (ordering): Missing 'direction'",
    "Q42b": "Part {p} (ordering): 'direction' must be 'vertical' or 'horizontal'",
    "Q43a": "Part {p} (ordering): Missing 'items'",
    "Q43b": "Part {p} (ordering): 'items' must be an array",
    "Q44a": "Part {p} (ordering): Missing 'correct_answer'",
    "Q44b": "Part {p} (ordering): 'correct_answer' must be an array",
    "Q45": "Part {p} (puzzle): Missing '{field}'",
    "Q46a": "Part {p} (puzzle): Missing 'pieces'",
    "Q46b": "Part {p} (puzzle): 'pieces' must be an array",
    "Q47a": "Part {p} (string): Missing 'ai_template_id'",
    "Q47b": "Part {p} (string): 'ai_template_id' must be a string",
    "Q48a": "Part {p} (string): Missing 'acceptable_answers'",
    "Q48b": "Part {p} (string): 'acceptable_answers' must be an array",
}

# Report columns "Failed Field" and "Expected Format" of the
# conversion rules; all other rules leave these columns empty.
REPORTED = {
    "K1": ("subject", "Non-empty string"),
    "K2": ("subject_id", "Non-empty string"),
    "K3": ("grade", "Non-empty string"),
    "K4": ("grade_id", "Non-empty string"),
    "K5": ("section_id", "Non-empty string"),
    "K6": ("parent_id", "Valid parent ID"),
}
