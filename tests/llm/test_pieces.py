from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from tessera.llm.pieces import decode_ids, encode_decode, encode_ids

PATH = public_tokenizers.path("piece_bpe_32k.model")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def texts() -> list[str | None]:
    draw = random.Random(7)
    letters = list("abcdehilnorstu   \n\t.,'-0123€é世▁🎉ÀA_=\0")
    mixed = ["".join(draw.choices(letters, k=draw.randint(0, 80))) for _ in range(1500)]
    runs = [c * n for c in (" ", "a", "=", "\n", "▁", "x ") for n in (1, 2, 3, 17, 300, 5000)]
    return [None, "", " ", "<s> </s> <0x0A>", *mixed, *runs, *runs]


def test_equals_the_library(small):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = [(i, t, "clash") for i, t in enumerate(texts())]
    docs = small(rows, "doc_id bigint, text string, n_tokens string")
    got = {r.doc_id: r for r in encode_decode(docs, PATH).collect()}
    assert len(got) == len(rows)
    for i, text, _ in rows:
        ids = library.encode(text or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == sha(",".join(map(str, ids)))
        assert got[i].decoded_sha256 == sha(library.decode(ids))


def test_round_trip_and_nulls(small):
    docs = small([(1, " two  words"), (1, " two  words"), (None, None)], "k bigint, body string")
    encoded = encode_ids(docs, PATH, "k", "body")
    assert sorted((r.doc_id or 0, r.text) for r in decode_ids(encoded, PATH).collect()) == [
        (0, ""),
        (1, " two  words"),
        (1, " two  words"),
    ]


@pytest.mark.parametrize("ids", [[3 + 0xE2, 3 + 0x82], [3 + 0xFF, 3 + 0x41]])
def test_invalid_bytes_decode_as_in_the_library(small, ids):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = small([(1, ids)], "doc_id bigint, ids array<int>")
    assert decode_ids(rows, PATH).first().text == library.decode(ids)


def test_empty_table(small):
    docs = small([], "doc_id bigint, text string")
    assert encode_decode(docs, PATH).count() == 0
