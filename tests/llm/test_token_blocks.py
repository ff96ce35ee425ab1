"""Blocks of the mixing coder and the tokenizer's short way for plain words."""

import zlib

import numpy as np
import public_tokenizers
import pytest

from tickerloom.llm.mixing_coder import BLOCK_IDS, HEADER, LANES, STEPS, decode_block, encode_block
from tickerloom.llm.token_files import ChunkEncoder, group_bytes, read_groups

WORDS = public_tokenizers.path("word_bpe_49k.json")


def decoded(coded: bytes) -> np.ndarray:
    _, length, lanes, size, payload, crc = HEADER.unpack_from(coded)
    assert len(coded) == HEADER.size + payload
    return decode_block(length, lanes, size, coded[HEADER.size :], crc)


@pytest.mark.parametrize("length", [1, 2, STEPS - 1, STEPS, STEPS + 1, 3 * STEPS + 7, 20_011])
@pytest.mark.parametrize("kind", ["zeros", "any", "largest", "words", "run"])
def test_blocks_come_back(kind, length):
    draw = np.random.default_rng(length)
    ids = {
        "zeros": np.zeros(length),
        "any": draw.integers(0, 1 << 16, length),
        "largest": np.full(length, 65_535),
        "words": np.minimum(draw.zipf(1.3, length), 49_000),
        "run": np.arange(length) % 97,
    }[kind].astype(np.uint16)
    assert (decoded(encode_block(ids)) == ids).all()


def test_lanes_learn_from_one_another():
    # A phrase seen in one lane is proposed in the others: 0.02 bytes an id beside each lane's first ids.
    phrase = np.random.default_rng(3).integers(0, 49_000, 5_000).astype(np.uint16)
    assert len(encode_block(np.tile(phrase, 60))) < 300_000 * 0.25


def test_damage_is_found():
    ids = np.arange(5_000, dtype=np.uint16) % 700
    coded = encode_block(ids)
    first_word = HEADER.size + 2 * -(-len(ids) // STEPS)
    for at in range(first_word, first_word + 40, 3):
        damaged = bytearray(coded)
        damaged[at] ^= 16
        with pytest.raises(ValueError):
            decoded(bytes(damaged))


def test_groups_of_several_blocks(tmp_path):
    ids = (np.arange(BLOCK_IDS + 1_000) % 11).astype("<u2")
    parts = [ids[:5].tobytes(), b"", ids[5:].tobytes()]
    (tmp_path / "f").write_bytes(group_bytes([3, None, -4], parts))
    with open(tmp_path / "f", "rb") as stream:
        got = [(d, i.astype("<u2").tobytes()) for d, i in read_groups(stream)]
    assert got == list(zip([3, None, -4], parts))
    assert LANES * STEPS == BLOCK_IDS and zlib.crc32(got[2][1]) == zlib.crc32(parts[2])


def test_plain_words_skip_the_whole_tokenizer_and_give_its_ids():
    encoder = ChunkEncoder(WORDS)
    latin = "".join(map(chr, [*range(0x21, 0x7F), *range(0xA1, 0x100)]))
    draw = np.random.default_rng(5)
    chunks = ["".join(draw.choice(list(latin), n)) for n in draw.integers(1, 9, 4_000)]
    chunks += [*latin, "it's", "THEY'LL", "a'sb", ".'s", "'re's", "“x”—y…", "‘a’", "«b»€5", "¿que?", "10•20", "Straße", "ÀÉÎÕÜß", "naïve3x", "don't", "İx", "ﬁne", "éa", "日本語", "a\x7fb", "x<|endoftext|>y", "<|startoftext|>", "½x²", "µªº"]
    for chunk in chunks:
        expected = encoder.tokenizer.encode(chunk, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(chunk), "<u2").tolist() == expected, chunk
    for text in ("a 's\tb\n\n it 's", "x\x0by\x0c z\r\nw", " 'll ''s 'S'T", "a\x1cb c", "a\u00a0b c", "<| startoftext|> x", ""):
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text
    calls = []
    encoder.direct = lambda text: calls.append(text) or b""
    encoder.encode("Plain wörds, ÉTÉ 1984 (a-b) all@new.example it's thrgh qzmerge")
    assert calls == []
