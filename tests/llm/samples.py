"""Small documents with every edge the operators define."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    parts = ["the", "of", "and", "ing", "er", "on", "re", "th", "ai", "eau", "sch", "ung", "tion", "é", "ß"]
    out = []
    for _ in range(n):
        w = "".join(r.choice(parts) for _ in range(r.randint(1, 4)))
        out.append(w.capitalize() + "." if r.random() < 0.05 else w)
    return " ".join(out)


def rows():
    out = [(i, prose(i, 20 + 7 * (i % 9)), "en", f"src{i % 4}" if i % 10 else None) for i in range(40)]
    out += [(40, None, None, None), (41, "", "en", "src0"), (42, " \n\t ", "en", "src1"), (43, "one", "en", "src1"),
            (44, "Trailing space ", "fr", "src2"), (45, prose(45, 4000), "en", "src2"),
            (46, "tab\there\x0bvt\x1cfs\xa0nbsp 　wide <|endoftext|> x<|startoftext|>y", "en", "src3"),
            (47, "İstanbul Σας 中文字 😀👍🏽 don't we'll x_y ²½ 3.14", "en", "src3"),
            (48, "x" * 70000, "en", "src0"), (49, prose(3, 41), "en", "src0"), (49, prose(3, 41), "en", "src0"),
            (None, prose(99, 30), "en", "src0"), (None, None, None, None), (50, prose(3, 41), "de", "src1")]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in out]
