"""The packing encoder against the tokenizer's own whole-text encoding."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from tracelake.llm import packing

ENCODER = packing.Encoder(packing.TOKENIZER)

STRETCHES = st.sampled_from(
    ["word", "Word.", "WORD!!", "it's", "'ll", "we'LL", "a1b22", "555-7485", "é.", "ß,", "İ!", "ſt", "Σας", "x́", "≮",
     " ", "½º", "中文", "🙂.", "\x1c", "</w>", "a</w>b", "<|endoftext|>", "<|ENDOFTEXT|>", "--", "{x}", "'", ""]
)
TEXTS = st.lists(st.tuples(STRETCHES | st.text(max_size=6), st.sampled_from(["", " ", "\n", "\t\x0b", "  "])), max_size=12)


def whole(text: str) -> list[int]:
    return [*ENCODER.tokenizer.encode(text, add_special_tokens=False).ids, packing.END_ID]


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_ids_equal_whole_text_encoding(stretches):
    text = "".join(a + b for a, b in stretches)
    assert ENCODER.encode(text.encode()).tolist() == whole(text)


def test_full_stores_are_emptied(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 5)
    encoder = packing.Encoder(packing.TOKENIZER)
    for n in range(6):
        text = f"alpha beta{'x' * n}. gamma{'y' * n}, delta epsilon zeta{n} eta!"
        assert encoder.encode(text.encode()).tolist() == whole(text)
    assert len(encoder.known) <= 7 and len(encoder.words) <= 7


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("HJTWYAehjtwy.'\u0331\u030c\u0308\u030a\u0323\u00c9\u00e9 "), max_size=12))
def test_capitals_before_combining_marks(text):
    assert ENCODER.encode(text.encode()).tolist() == whole(text)


def test_marks_that_compose_only_with_small_letters():
    for stretch in ("H\u0331ava", "J\u030c", "T\u0308", "W\u030a", "xH\u0331", "Y\u030a.", "\u00c9T\u0308"):
        assert ENCODER.encode(f"a {stretch} Bc {stretch.lower()}".encode()).tolist() == whole(f"a {stretch} Bc {stretch.lower()}")
