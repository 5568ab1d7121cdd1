import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfpulse.llm.tokens import Merger, count_tokens, with_token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def machine():
    return Merger(PATH)


def check(library, machine, texts):
    expected = [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]
    assert count_tokens(texts, machine).tolist() == expected


def test_edge_texts(library, machine):
    check(
        library,
        machine,
        ["", " ", "it's we'll I'd 're 'rex 've 'l 'll  '", "a\n\n b \n", "a" * 5000, "\n'll \n 's",
         "x<|endoftext|>y<|endoftext|>", "<|endoftext|>", "日本語" * 900, "'" * 99, "\0a\0", "1²½ ⅷ",
         "tab\t \tend ", "\r\n\r\n", "👍🏽" * 300, " " * 3000],
    )


def test_random_texts(library, machine):
    random.seed(3)
    parts = [*"abcst'rvle 12\n\t.,!é日😀 ", "  ", "'re", "'ll", "<|endoftext|>", "ing", " the"]
    check(library, machine, ["".join(random.choices(parts, k=random.randint(0, 70))) for _ in range(3000)])


def test_every_code_point(library, machine):
    check(library, machine, [f"a{chr(c)}a {chr(c)}{chr(c)}1" for c in range(1, 0x3100)])


def test_states_start_over_when_they_are_many(library):
    small = Merger(PATH, most_states=200)
    random.seed(4)
    texts = ["".join(random.choices("abcdeingthro ", k=400)) for _ in range(30)]
    for text in texts:
        check(library, small, [text])


def test_odd_rows(library, odd_docs, no_docs):
    rows = with_token_counts(odd_docs, PATH).collect()
    given = odd_docs.select("doc_id", "text").collect()
    expected = sorted(
        (str(r["doc_id"]), len((r["text"] or "").encode()),
         len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in given
    )
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in rows) == expected
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in rows)
    assert with_token_counts(no_docs, PATH).count() == 0
