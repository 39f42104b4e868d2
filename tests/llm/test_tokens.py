import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from geolith.llm.tokens import encoder

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
PIECES = st.sampled_from(["a", "Foo", "bar.", "x,", "É", "straße", "naïve", "ŝ", "é", "́", "'s", "don't", "I'LL", "12", "3.5", "##", "foo%%%", "_x_", " ", "  ", "\n", "\t", "\r\n", "\xa0", "\x85", "　", "\x1c", "ß", "ª", "µ", "İ", "Σ", "日本", "<|endoftext|>", "🙂", "\x00", "ſ", "K"])


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=12).map("".join))
def test_same_as_library(name, text):
    e = encoder(public_tokenizers.path(name))
    assert np.frombuffer(e.ids(text), "<u2").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_same_as_library_on_any_text(name, text):
    e = encoder(public_tokenizers.path(name))
    assert np.frombuffer(e.ids(text), "<u2").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", FILES)
def test_letters_that_end_in_marks(name):
    e = encoder(public_tokenizers.path(name))
    for c in ("\u0130", "\u0958", "\u0929", "\ufb1d", "\u1e9e", "\u01c5", "e\u0301"):
        for text in (f"{c}##", f"a{c}.", f"x {c}{c}!? b", f"{c}\n{c}#"):
            assert np.frombuffer(e.ids(text), "<u2").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_null_and_empty():
    e = encoder(public_tokenizers.path(FILES[0]))
    assert e.ids(None) == e.ids("") == b""
