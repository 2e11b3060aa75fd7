"""Small invented documents."""

import copy


def choices(kinds, **more):
    return [
        {"type": kind, "html_content": f"<p>{chr(97 + i)}</p>", "values": [], "unit": None, "index": i,
         "fixed_order": len(kinds) - i, "last_order": False, **{k: v[i] for k, v in more.items() if v[i] is not None}}
        for i, kind in enumerate(kinds)
    ]


D, K = "distractor", "key"
OWN = {
    "mcq": {"choices": choices([K, D, D])},
    "mrq": {"choices": choices([K, D, K])},
    "opinion": {"choices": choices([D, D])},
    "oq": {"direction": "vertical", "choices": choices([D, D, D], correct_order=[2, 3, 1])},
    "matching": {"choices": choices([D] * 4, group=[1, 1, 2, 2], correct_order=[1, 2, 2, 1])},
    "gmrq": {"choices": choices([K, D, D, K], group=[1, 1, 2, 2])},
    "frq": {"choices": [], "answer": "because", "ai": {"ai_template_id": 123456789012}},
    "frq_ai": {"choices": [], "answer": "because", "ai": {"ai_template_id": "123456789012"}},
    "gapText": {
        "stem": '<p>One <span data-node-variation="gap">x</span> two <span data-node-variation="gap">y</span>.</p>',
        "choices": [],
        "gap_text_keys": [{"value": "B", "correct_order": 2}, {"value": "none"}, {"value": "A", "correct_order": 1}]},
    "string": {"choices": None, "answer": ["yes"], "ai": {"ai_template_id": 593158513739, "guidelines": [
        {"student_answer": "yes", "mark": "1", "comment": "right"},
        {"student_answer": "no", "mark": 0, "comment": "wrong"}]}},
    "counting": {"choices": [], "answer": "٦", "grid_size": "2×3"},
    "puzzle": {"choices": [], "puzzleRows": "1", "puzzleColumns": 2, "puzzleImage": "i.png", "puzzleImageWidth": "5",
               "puzzleImageHeight": 6, "puzzleImageSplited": [
                   {"index": 1, "fixed_order": 2, "correct_order": 1, "src": "a"},
                   {"index": 2, "fixed_order": 1, "correct_order": 2, "src": "b"}]},
    "input_box": {"choices": [], "answer": {"value": "٢٫٥", "constrains": {"type": "decimal", "sign": None}}},
}


def part(kind, n=1, **changes):
    return {"n": n, "type": kind, "stem": "<p>Why?</p>", "standalone": True, **copy.deepcopy(OWN[kind]), **changes}


def document(*parts, **changes):
    doc = {
        "parts": list(parts), "metadata": {"id": 7, "mapped_id": 42, "language": "en", "country": "zz"},
        "language": " EN ", "country": "us", "question_id": "42", "subject": "Maths", "subject_id": 5,
        "grade": 4, "grade_id": "11", "section_id": "9", "source": "human",
    }
    doc.update(changes)
    return doc
