"""The piece-wise encoder against the library on arbitrary texts."""

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from traceframe.llm.tokenbin import Words

WORDS = Words(public_tokenizers.path("word_bpe_49k.json"))
SIGNS = st.one_of(st.sampled_from(list("abcXYZ.,. ,'\n\t<|>0é́ΣİßÅK\xa0")), st.characters(blacklist_categories=("Cs",)))


@pytest.mark.parametrize("text", ["a <|ENDOFTEXT|> b.", "A<|EndOfText|>, b", "A <|endoftext|>. B", "6 ÷. 2", "÷, x", "a÷. B 3 ÷.", "Ü. ÿ, Ø. ö."])
def test_special_tokens_and_signs_among_letters(text):
    assert WORDS.encode([text])[0] == np.array(WORDS.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=600, deadline=None)
@given(st.lists(st.text(alphabet=SIGNS, max_size=8), max_size=6))
def test_pieces_give_the_ids_of_the_whole_text(pieces):
    text = " ".join(pieces)
    assert WORDS.encode([text])[0] == np.array(WORDS.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


class _Counted(dict):
    """Counts what is looked up."""

    asked = 0

    def get(self, *key):
        self.asked += 1
        return super().get(*key)


def test_a_piece_is_looked_up_once_for_all_texts_of_a_slice():
    own = Words(public_tokenizers.path("word_bpe_49k.json"))
    own.ids = _Counted()
    texts = ["alpha beta, gamma. " * 300, None, " ", "beta alpha!! été　x " * 200, "gamma gamma"]
    want = [np.array(own.tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert own.encode(texts) == want
    assert 0 < own.ids.asked < 10
    assert own.encode(texts) == want and own.encode([]) == []
