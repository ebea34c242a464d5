"""Token files and the word shuffle against the tokenizer libraries."""

import base64
import gc
import hashlib
import io
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as tokens
import pytest
import tiktoken
from corpus_cases import awkward_texts, frame
from tokenizers import Tokenizer

from namelink.llm.bpe_shuffle import bpe_round_trip, decode, encode, pack, unpack
from namelink.llm.bpe_words import PartCache, parts_of
from namelink.llm.shared import new_folder
from namelink.llm.token_files import TokenFile, TokenFileWriter, token_file_round_trip, write_token_files

JSON, RANKS = tokens.path("byte_bpe_50k.json"), tokens.path("byte_bpe_50k.tiktoken")
PIECES = [" ", "  ", "\n", "\t", "a", "Ab", "12", ".", "'s", "'", "é", "\xa0", "\x1c", "\x85", "中", "💥", "_", "٣", "<|endoftext|>", "Ⅷ"]


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(JSON)
    found.encode_special_tokens = True
    return found


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("test", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_parts_do_not_depend_on_each_other(library, encoding):
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 12)))
        parts = parts_of(text)
        assert "".join(parts) == text
        assert [i for p in parts for i in library.encode(p, add_special_tokens=False).ids] == library.encode(
            text, add_special_tokens=False).ids
        assert [i for p in parts for i in encoding.encode_ordinary(p)] == encoding.encode_ordinary(text)


def test_token_files_match_the_library(spark):
    library = Tokenizer.from_file(JSON)  # as it is: strings of special tokens are special tokens
    rows = awkward_texts() + [(40, "a  <|endoftext|>  b <|endoftext|>"), (41, "<|endoftext|>"), (42, "<|endoftext |>")]
    got = token_file_round_trip(frame(spark, rows), JSON).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected, start = [], 0
    for doc_id, text in order:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert Counter(map(tuple, got)) == Counter(expected)


def test_token_files_of_nothing(spark):
    assert token_file_round_trip(frame(spark, []), JSON).collect() == []


def test_reader_decompresses_only_what_it_needs(spark, tmp_path):
    manifest = write_token_files(frame(spark, awkward_texts()), new_folder(spark, "test"), JSON, frame_bytes=64)
    rows = manifest.collect()
    assert sum(r["n_docs"] for r in rows) == len(awkward_texts())
    seen = []
    for r in rows:
        with open(r["path"].removeprefix("file://"), "rb") as source:
            file = TokenFile(source)
            plain, file.frame = file.frame, lambda k, plain=None: seen.append(k) or original(k)
            original = plain
            assert len(file.read(7)) <= 1
            assert len(seen) < max(3, len(file))
            seen.clear()


def test_damaged_frames_are_found():
    class Kept(io.BytesIO):
        def close(self):
            pass

    out = Kept()
    writer = TokenFileWriter(out, frame_bytes=400)
    for k in range(50):
        writer.add(k, np.arange(k, dtype="<u4").tobytes())
    writer.close()
    file = TokenFile(io.BytesIO(out.getvalue()))
    assert [len(x) for k in range(50) for x in file.read(k)] == list(range(50))
    assert file.read(99) == []
    file.entries[1] = (*file.entries[1][:2], file.entries[1][2] ^ 1)
    with pytest.raises(ValueError, match="checksum"):
        file.frame(1)
    with pytest.raises(ValueError, match="seek table"):
        TokenFile(io.BytesIO(out.getvalue()[:-1]))


def test_pack_round_trip():
    numbers = np.array([0, 1, 2**32 - 1, 77], "<u4")
    a, b, c = unpack(pack(numbers, b"bytes", np.zeros(0, "<u4")))
    assert a.tolist() == numbers.tolist() and b == b"bytes" and len(c) == 0


@pytest.mark.parametrize("block_chars", [100, 8_000_000])
def test_word_shuffle_matches_the_library(spark, encoding, block_chars):
    rows = awkward_texts()
    got = decode(encode(frame(spark, rows), RANKS, tokens.PATTERN, block_chars=block_chars), RANKS).collect()
    expected = Counter((i, np.array(encoding.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in rows)
    assert Counter((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in got) == expected


def test_word_shuffle_digest(spark):
    row = bpe_round_trip(frame(spark, [(1, None)]), RANKS, tokens.PATTERN).first()
    empty = hashlib.sha256(b"").hexdigest()
    assert tuple(row) == (1, 0, empty, empty)
    assert bpe_round_trip(frame(spark, []), RANKS, tokens.PATTERN).collect() == []


def test_remembered_parts_are_not_walked_by_the_collector():
    """A cache that the collector walks costs more with every part in it."""
    asked = []

    def encode(parts):
        asked.extend(parts)
        return [f"<{p}>".encode() for p in parts]

    cache = PartCache(encode, limit=50)
    lists = [["a", " b", " b", " word,"], [], [" b", " word", " 1,"], ["a", " new", " b", " new"]]
    for _ in range(2):
        assert cache.of_all(lists) == [b"<a>< b>< b>< word><,>", b"", b"< b>< word>< 1,>", b"<a>< new>< b>< new>"]
    assert len([p for p in asked if p not in (",", ".")]) == len({" b", "a", " word", " 1,", " new"})
    assert cache.of_all([[f" {k}" for k in range(60)]]) == [b"".join(b"< %d>" % k for k in range(60))]
    assert cache.of_all([["a"]]) == [b"<a>"] and len(cache) == 3
    assert not gc.is_tracked(cache.known)
