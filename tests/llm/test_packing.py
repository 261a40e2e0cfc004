from __future__ import annotations

import random
from collections import Counter

import public_tokenizers
from brute import pieces
from tokenizers import Tokenizer

from lexmill.llm.packing import fullest, pack_documents, plan_bins
from lexmill.llm.tokens import ChunkEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_pieces_and_places(odd_docs, odd_rows, no_docs):
    got = pack_documents(odd_docs, PATH).collect()
    plain = Tokenizer.from_file(PATH)
    assert sorted(tuple(r)[:5] for r in got) == sorted(pieces(plain, [r[:2] for r in odd_rows], 1024, 2))
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(bins) <= -(-sum(r["length"] for r in got) // 1024) + 1
    assert pack_documents(no_docs, PATH).collect() == []


def test_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(None, "a b"), (None, None), (1, "c"), (1, "c"), (1, "d")], "doc_id long, text string")
    got = pack_documents(df, PATH).collect()
    assert len(got) == 5 and len({(r["sequence_id"], r["offset"]) for r in got}) == 5


def test_fullest_combination():
    rnd = random.Random(1)
    for _ in range(200):
        counts = Counter(rnd.randint(1, 20) for _ in range(rnd.randint(0, 6)))
        room = rnd.randint(0, 40)
        sums = {0}
        for length, n in counts.items():
            for _ in range(n):
                sums |= {s + length for s in sums}
        taken = fullest(dict(counts), room)
        assert sum(k * v for k, v in taken.items()) == max(s for s in sums if s <= room)
        assert all(counts[k] >= v for k, v in taken.items())


def test_plan_uses_everything_once():
    rnd = random.Random(2)
    counts = {rnd.randint(1, 1024): rnd.randint(1, 50_000) for _ in range(300)}
    plan = plan_bins(dict(counts))
    used = Counter()
    for times, combination in plan:
        assert sum(k * v for k, v in combination.items()) <= 1024
        for k, v in combination.items():
            used[k] += times * v
    assert used == Counter(counts)


def test_as_few_bins_as_first_fit_decreasing():
    rnd = random.Random(4)
    for longest in (1024, 600, 200):
        counts = Counter(rnd.randint(1, longest) for _ in range(3000))
        free = []
        for length in sorted(counts.elements(), reverse=True):
            at = next((i for i, room in enumerate(free) if room >= length), None)
            if at is None:
                free.append(1024 - length)
            else:
                free[at] -= length
        assert sum(t for t, _ in plan_bins(dict(counts))) <= 1.005 * len(free)


def test_ids_are_those_of_whole_texts():
    encoder, rnd = ChunkEncoder(PATH, cache_entries=50), random.Random(3)
    letters = list("ab1.,'!-_ \n\t\r\x1c\x85  é漢😀  ")
    texts = ["", " ", "it's o'clock 's 't", "a\n\nb c", "x y z", "<|endoftext|> b"] + ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 30))) for _ in range(5000)]
    for text in texts:
        ids = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == b"".join(i.to_bytes(4, "little") for i in ids), text


def test_added_tokens_keep_their_id():
    plain, encoder = Tokenizer.from_file(PATH), ChunkEncoder(PATH)
    assert plain.encode("one <|endoftext|> two", add_special_tokens=False).ids == [505, 220, 50256, 734]
    for text in ["one <|endoftext|> two", "<|endoftext|>", "a<|endoftext|>b c", "it's <|endoftext|><|endoftext|>\n x", "one <|endoftext |> two", "é  <|endoftext|>"]:
        ids = plain.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == b"".join(i.to_bytes(4, "little") for i in ids), text


def test_no_token_spans_two_words_of_the_pattern():
    """What lets a chunk go to the model at once: every entry is one match of the word pattern."""
    import regex

    pattern = regex.compile(public_tokenizers.PATTERN)
    encoder = ChunkEncoder(PATH)
    back = {ord(v): k for k, v in encoder.letters.items()}
    for token in set(encoder.tokenizer.get_vocab()) - {"<|endoftext|>"}:
        text = token.translate(back).encode("latin-1", "ignore").decode("utf-8", "ignore")
        if text.strip() and "'" not in text and not regex.search(r"\s", text[1:]):
            assert len(pattern.findall(text)) == 1, token
