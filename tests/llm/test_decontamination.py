from __future__ import annotations

import hashlib
import re
from string import ascii_lowercase, ascii_uppercase

from tessera.llm.decontamination import decontaminate

FOLD = str.maketrans(ascii_uppercase, ascii_lowercase)
NUMBERS = [f"word{i}" for i in range(40)]
ITEMS = [
    (1, " ".join(NUMBERS[:12])),
    (2, "Short Ones, three"),
    (3, " ".join(NUMBERS[:12])),
    (10, "a " * 15),
    (5, None),
    (6, " ,; "),
    (None, "unlisted but hit"),
    (7, "é É"),
]
DOCS = [
    (1, "start " + " ".join(NUMBERS[:12]).upper() + " end"),
    (2, "x " + " ".join(NUMBERS[1:11]) + " y " + " ".join(NUMBERS[2:11])),
    (3, "there were short-ones THREE times: short ones three"),
    (4, None),
    (5, ""),
    (6, "a " * 30 + "b"),
    (7, "é é É"),
    (7, "a a a"),
    (8, "unlisted but hit"),
    (8, "unlisted but hit"),
    (None, "short ones three"),
    (9, "nothing of it"),
    (9, " ".join(NUMBERS[20:]) * 200),
]


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def expected(doc_id, text, items):
    ws, hit, found = split(text), set(), set()
    for item_id, item in items:
        iw = split(item)
        n = min(10, len(iw))
        for s in range(len(iw) - n + 1 if iw else 0):
            for at in range(len(ws) - n + 1):
                if ws[at : at + n] == iw[s : s + n]:
                    hit |= set(range(at, at + n))
                    found |= {item_id} - {None}
    ids = ",".join(sorted(map(str, found)))
    sha = hashlib.sha256(ids.encode()).hexdigest()
    return (doc_id, len(ws), len(hit), len(found), sha, bool(hit))


def test_equals_brute_force(small):
    docs = small([(*d, 1) for d in DOCS], "doc_id bigint, text string, n_hit int")
    items = small(ITEMS, "item_id bigint, text string")
    got = [tuple(r) for r in decontaminate(docs, items).collect()]
    assert sorted(got, key=repr) == sorted((expected(*d, ITEMS) for d in DOCS), key=repr)


def test_empty_tables(small):
    docs = small(DOCS, "doc_id bigint, text string")
    items = small(ITEMS, "item_id bigint, text string")
    assert decontaminate(docs.limit(0), items).count() == 0
    assert decontaminate(docs, items.limit(0)).where("contaminated").count() == 0


GREEK_ITEMS = [
    (1, "Η ΕΤΑΙΡΕΙΑ Α.Σ. ΤΗΣ ΑΘΗΝΑΣ ΚΑΙ Ο ΛΟΓΟΣ.ΚΑΙ ΤΟΥΣ'ΑΛΛΟΥΣ:ΟΛΟΥΣ ΜΑΖΙ"),
    (2, "Ο ΛΟΓΟΣ.ΚΑΙ"),
    (3, "Α.Σ. ΤΗΣ"),
]
GREEK_DOCS = [
    (1, "xx " + GREEK_ITEMS[0][1] + " yy"),
    (2, "ο λογος και " + GREEK_ITEMS[1][1]),
    (3, "Ο ΛΟΓΟΣ ΚΑΙ"),
    (4, "xx Α Σ ΤΗΣ yy"),
    (5, GREEK_ITEMS[0][1].lower()),
]


def test_capital_sigma_before_a_word_border(small):
    docs = small(GREEK_DOCS, "doc_id bigint, text string")
    items = small(GREEK_ITEMS, "item_id bigint, text string")
    got = [tuple(r) for r in decontaminate(docs, items).collect()]
    assert sorted(got) == sorted(expected(*d, GREEK_ITEMS) for d in GREEK_DOCS)
