"""Cross-tokenizer alignment against plain Python and the tokenizer libraries."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers as tokens
import pytest
import sentencepiece
from corpus_cases import awkward_texts, frame
from tokenizers import Tokenizer, pre_tokenizers

from namelink.llm.token_align import Aligner, align_documents, align_texts, alignment_report

FIRST, SECOND = tokens.path("byte_bpe_50k.json"), tokens.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(FIRST)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=SECOND)


def spans(ids, raws):
    at, out = 0, []
    for number, raw in zip(ids, raws):
        out.append((at, at + len(raw), number))
        at += len(raw)
    return out


def tokenise(libraries, text):
    """Spans of both tokenizers in bytes; the byte alphabet is read off the library."""
    first, second = libraries
    letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    sign = {letters.pre_tokenize_str(c)[0][0]: c.encode()[0] for c in map(chr, range(128))}
    raw = (" " + text).encode()
    enc = first.encode(" " + text, add_special_tokens=False)
    a, at = [], 0
    for number, token in zip(enc.ids, enc.tokens):
        n = len(token)  # one sign per byte
        assert all(c not in sign or sign[c] == raw[at + k] for k, c in enumerate(token))
        a.append((at, at + n, number))
        at += n
    b_ids = second.encode(text)
    pieces = [second.id_to_piece(i) for i in b_ids]
    raws = [bytes([int(p[3:-1], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b_ids, pieces)]
    if not text or b"".join(raws) != raw:
        return [], []
    return a, spans(b_ids, raws)


def brute(libraries, rows):
    done, counts = [], Counter()
    for doc_id, text in rows:
        a, b = tokenise(libraries, text or "")
        links = [(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]]
        counts.update(set(links))
        ends = sorted({x[1] for x in a} & {y[1] for y in b})
        groups, start = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(x[2]) for x in side if start < x[1] <= end) for side in (a, b)))
            start = end
        done.append((doc_id, len(a), len(b), len(groups), links, ";".join(groups)))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return Counter(
        (i, n_a, n_b, n_groups, len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links),
         hashlib.sha256(text.encode()).hexdigest() if text else "")
        for i, n_a, n_b, n_groups, links, text in done
    )


def rows():
    return [(i, t if t is None else t[:400]) for i, t in awkward_texts()] + [
        (30, "the same text again"), (31, "the same text again"), (32, "the same text again"), (33, "<|endoftext|> </s> <s>"),
        (34, "▁sign"), (35, "a  b   c"), (36, " lead and trail "), (37, "naïve café 東京   x"), (38, "tab\there\nline"),
    ]


@pytest.mark.parametrize("block_chars", [50, 1_000_000])
def test_measures_match_brute_force(spark, libraries, block_chars):
    got = align_documents(frame(spark, rows()).repartition(3), FIRST, SECOND, block_chars)
    assert Counter(map(tuple, got.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())) == brute(libraries, rows())


def test_parts_give_what_whole_texts_give(libraries):
    """Any mix of spaces, white space, signs and letters; one worker's memory throughout."""
    import random

    rng, tools = random.Random(5), Aligner(FIRST, SECOND)
    pieces = [" ", "  ", "\n", "\t", "a", "Ab", "12", ".", "'s", "é", "\xa0", "\x1c", "\x85", "中", "💥", "▁", "<|endoftext|>", "<0x0A>", "</s>", "\u3000"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    for text, found in zip(texts, tools.align_all(texts)):
        a, b = tokenise(libraries, text)
        assert (found is None) == (not a), repr(text)
        if found:
            assert found[:2] == (len(a), len(b)), repr(text)
            links = [(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]]
            assert [divmod(int(p), 1 << 32) for p in found[4]] == links, repr(text)


def test_each_distinct_text_once(spark):
    found = align_texts(frame(spark, rows()), FIRST, SECOND).select("digest", "n_docs").collect()
    texts = Counter(t or "" for _, t in rows())
    assert {bytes(r["digest"]): r["n_docs"] for r in found} == {hashlib.sha256(t.encode()).digest(): n for t, n in texts.items()}


def test_common_text_is_spread(spark, libraries):
    many = [(i, "one very common text") for i in range(2500)] + [(9000, "another"), (None, None)]
    got = Counter(map(tuple, alignment_report(frame(spark, many).repartition(4), FIRST, SECOND).collect()))
    assert got == brute(libraries, many)


def test_empty_table(spark):
    assert alignment_report(frame(spark, []), FIRST, SECOND).collect() == []
