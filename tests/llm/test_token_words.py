"""Words apart from their punctuation: the library's ids, each core merged once, within the bounds of the cache."""

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from moodmill.llm import range_coder, token_ids

BYTES = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(BYTES)
CORES = ["word", "Wörd", "don't", "o'", "x1", "日本", "слово", "ª", "é", "é", "٣", "a×", "ǅ", "a·b", "a­b", "<|endoftext|>", "x<|endoftext|>y", "q" * 80]
ENDS = ["", ",", ".", "!?", "'", "'s", "…,", "»", "\").", "<", "|>", "-", "_", "$$$", "*é", "\x00", "​"]


def ids_of(encode, texts):
    return [np.frombuffer(ids, "<u4").tolist() for ids in encode(texts)]


def wanted(texts):
    return [LIBRARY.encode(t or "", add_special_tokens=False).ids for t in texts]


def odd_texts():
    words = [start + core + end for core in CORES for end in ENDS for start in ("", "(", "'")]
    lines = [" ".join(words[i : i + 7]) for i in range(0, len(words), 7)]
    spaces = [f"a{c}b and {c} c{c}" for c in "\t\r\x0b\x0c\x1c\x1f\x85\xa0 ᠎  　"]
    return [*words, *lines, "\n".join(lines), "\n".join(words), *spaces, "a \nb", "\na", "a\n", " a", "a ", "a\n\nb", "...", ", .", None, ""]


def test_ends_of_words_give_the_library_ids():
    texts = odd_texts()
    assert ids_of(token_ids.spaced_encoder(BYTES), texts) == wanted(texts)


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_columns_and_small_groups(kind, monkeypatch):
    """Spark's own columns, cut anywhere, with a cache that is full after a few words."""
    monkeypatch.setattr(token_ids, "GROUP_BYTES", 200)
    monkeypatch.setattr(token_ids, "CACHE_WORDS", 30)
    monkeypatch.setattr(token_ids, "CACHE_TAILS", 3)
    texts = odd_texts()
    encode = token_ids.spaced_encoder(BYTES)
    column = pa.array(["before", *texts], kind)[1:]
    for _ in range(2):
        assert ids_of(encode, column) == wanted(texts)
    assert encode(pa.array([], kind)) == []


def test_a_core_is_encoded_once(monkeypatch):
    asked = []
    encode_cores = token_ids._Cores.encode
    monkeypatch.setattr(token_ids._Cores, "encode", lambda self, cores: asked.extend(cores) or encode_cores(self, cores))
    encode = token_ids.spaced_encoder(BYTES)
    texts = [f"first{end} plain{end} Größe{end} plain" for end in ("", ",", ".", "!", "$$$", '")')] * 50
    assert ids_of(encode, texts) == wanted(texts)
    assert ids_of(encode, texts) == wanted(texts)
    assert sorted(asked) == sorted(["\nfirst", "plain", "Größe"])


def test_all_blocks_of_a_coder_run_come_back():
    """More blocks than lanes, of ragged lengths, with ids that are and are not in every table."""
    rng = np.random.default_rng(5)
    blocks = [rng.zipf(1.3, n).clip(0, 65_535).astype(np.uint16) for n in rng.integers(0, 40, range_coder.LANES + 300)]
    blocks[7] = rng.integers(0, 1 << 16, 3000).astype(np.uint16)
    blocks[9] = np.tile(np.arange(300, dtype=np.uint16), 10)
    coded = range_coder.encode(blocks)
    back = range_coder.decode(coded, [len(b) for b in blocks])
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back, strict=True))
    assert len(coded[9]) < 2 * 3000 / 2
