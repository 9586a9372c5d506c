import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from ebbtide.llm import tokens
from tests.llm.cases import LONG, TEXTS

PATH = public_tokenizers.path("byte_bpe_50k.json")
LATIN = st.text(st.characters(max_codepoint=0xFF), max_size=60)


@settings(max_examples=400, deadline=None)
@given(LATIN | st.text(max_size=30) | st.lists(st.sampled_from(["<|endoftext|>", " ", "  ", "\n", "'s", "'", "ab", "12", "\xa0", "\x85", "\x1c", "é!"])).map("".join))
def test_ids_are_those_of_the_files_own_library(text):
    encoder = tokens.encoder(PATH)
    assert encoder.ids(text).tolist() == encoder.slow(text)


def test_awkward_texts():
    encoder = tokens.encoder(PATH)
    for _, text in TEXTS:
        if text != LONG:
            assert encoder.ids(text).tolist() == encoder.slow(text or "")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", " b", "  ", " \n", "\n ", "'s", " 12", "é", " \xa0x", "<|endoftext|>", " <|endoftext|>"]), max_size=60).map("".join), st.integers(1, 7))
def test_parts_give_the_same_ids(text, size):
    encoder = tokens.encoder(PATH)
    cut = tokens.parts(text, size)
    assert "".join(cut) == text
    assert [i for part in cut for i in encoder.slow(part)] == encoder.slow(text)


def test_other_kinds_of_files():
    for name in ("piece_bpe_32k.model", "word_bpe_49k.json"):
        encoder = tokens.Encoder(public_tokenizers.path(name))
        assert not encoder.cuttable
        assert len(encoder.ids("Hello there, world")) > 2
