"""Best-fit packing: the reduction against an exact solver, the plan piece by piece, ids by the tokenizer."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marquee.llm import best_fit, packing


def fewest(items, capacity):
    """Sequences of a best packing, by trying all."""
    items = sorted(items, reverse=True)
    best = len(items)

    def place(at, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if at == len(items):
            best = len(rooms)
            return
        for room in sorted(set(rooms)):
            if room >= items[at]:
                i = rooms.index(room)
                place(at + 1, [*rooms[:i], room - items[at], *rooms[i + 1 :]])
        place(at + 1, [*rooms, capacity - items[at]])

    place(0, [])
    return best


INSTANCES = st.integers(6, 40).flatmap(
    lambda c: st.tuples(st.just(c), st.integers(1, c // 3).flatmap(
        lambda low: st.lists(st.integers(low, c), min_size=1, max_size=9)))
)


@settings(max_examples=1500, deadline=None)
@given(INSTANCES)
def test_fixed_sets_belong_to_a_best_packing(instance):
    capacity, items = instance
    fixed, rest = best_fit.reduced(Counter(items), capacity)
    left = list(Counter(rest).elements())
    assert all(sum(lengths) <= capacity and len(lengths) <= 3 for lengths, _ in fixed)
    assert sorted(left + [x for lengths, n in fixed for x in lengths * n]) == sorted(items)
    assert fewest(items, capacity) == sum(n for _, n in fixed) + fewest(left, capacity)


@settings(max_examples=400, deadline=None)
@given(st.integers(6, 60), st.lists(st.integers(1, 60), min_size=1, max_size=60))
def test_plan_gives_every_rank_one_place(capacity, lengths):
    counts = Counter(min(x, capacity) for x in lengths)
    lines, total = best_fit.plan(counts, capacity)
    sequences = defaultdict(list)
    for length, n in counts.items():
        own = [line for line in lines if line[0] == length]
        for rank in range(n):
            _, first_rank, each, first, offset = [line for line in own if line[1] <= rank][-1]
            at = rank - first_rank
            sequences[first + at // each].append((offset + at % each * length, length))
    assert sorted(sequences) == list(range(total))
    for places in sequences.values():
        places.sort()
        assert [at for at, _ in places] == list(np.cumsum([0, *(n for _, n in places)])[:-1])
        assert sum(n for _, n in places) <= capacity
    _, rest = best_fit.reduced(counts, capacity)
    rooms = []  # best fit piece by piece
    for length in sorted(Counter(rest).elements(), reverse=True):
        room = min((r for r in rooms if r >= length), default=None)
        if room is not None:
            rooms.remove(room)
        rooms.append((capacity if room is None else room) - length)
    fixed, _ = best_fit.reduced(counts, capacity)
    assert total == sum(n for _, n in fixed) + len(rooms)


def test_plan_does_not_grow_with_documents():
    random = np.random.default_rng(3)
    lengths = np.clip(random.lognormal(6, 1.2, 300_000).astype(int), 1, 2048)
    small = best_fit.plan(Counter(lengths.tolist()))
    large = best_fit.plan({x: n * 100_000 for x, n in Counter(lengths.tolist()).items()})
    assert len(large[0]) < 4 * 2048 * 63 and len(large[0]) < 2 * len(small[0])
    assert small[1] <= 1.01 * lengths.sum() / 2048 and large[1] <= 1.01 * 100_000 * lengths.sum() / 2048


@pytest.fixture(scope="module")
def source():
    import public_tokenizers

    return packing.tokenizer_file(public_tokenizers.path("word_bpe_49k.json"))


def test_chunks_have_the_ids_of_the_whole_text(source, monkeypatch):
    from tokenizers import Tokenizer

    model = Tokenizer.from_str(source.decode())
    encode = best_fit.Encoder(source)
    texts = ["", " ", "It's 1234 o'clock\n\n <|endoftext|>x <|startoftext|>", "á ́b ΑΣ Σ ΑΣ\n'S 'Re don't", "\x1c\x85a b　c", "x" * 500]
    texts += ["".join(f" {chr(c)}a{chr(c)} {chr(c)}\n" for c in range(at, at + 64) if not 0xD800 <= c < 0xE000) for at in range(0, 0x30000, 64)]
    assert encode.plain
    want = [model.encode(text, add_special_tokens=False).ids for text in texts]
    for block, most in ((1 << 23, 400_000), (100, 400_000), (1 << 12, 500)):  # one block, many; a full memory
        monkeypatch.setattr(best_fit, "BLOCK_CHARS", block)
        monkeypatch.setattr(best_fit, "REMEMBERED", most)
        assert [np.frombuffer(ids, "<u4").tolist() for ids in encode(texts)] == want
        assert not any(len(chunk) > best_fit.CHUNK for chunk in encode.seen)


def test_every_token_is_packed_once(spark, source, tables):
    from tokenizers import Tokenizer

    model = Tokenizer.from_str(source.decode())
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{tables}/documents.parquet").collect()]
    texts += [(-1, None), (-2, ""), (-3, "long and longer words\n" * 3000), (-4, "twice"), (-4, "twice"), (None, "no id")]
    frame = spark.createDataFrame([(*t, "clash", "clash") for t in texts], "doc_id long, text string, rank string, length string")
    rows = best_fit.packed(frame, source).collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    whole = 0
    for doc, text in texts:
        ids = [*(model.encode(text, add_special_tokens=False).ids if text else []), 0]
        whole += len(ids)
        parts = [ids[at : at + 2048] for at in range(0, len(ids), 2048)]
        want = {(n, n * 2048, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for n, p in enumerate(parts)}
        assert {(r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[doc]} == want
    assert len(by_doc[-4]) == 2 and sum(r.length for r in rows) == whole
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        places.sort()
        assert [at for at, _ in places] == list(np.cumsum([0, *(n for _, n in places)])[:-1])
        assert sum(n for _, n in places) <= 2048
    assert len(sequences) <= 1.02 * whole / 2048 + 1
    none = spark.createDataFrame([], "doc_id long, text string")
    assert best_fit.packed(none, source).collect() == []


def test_a_known_word_is_not_encoded_again_for_its_marks(source):
    from types import SimpleNamespace

    encode = best_fit.Encoder(source)
    model, asked = encode.model, []

    def tokenize(part):
        asked.append(part)
        return model.model.tokenize(part)

    encode.model = SimpleNamespace(
        model=SimpleNamespace(tokenize=tokenize), encode_batch_fast=model.encode_batch_fast
    )
    texts = ["alpha beta", "Alpha, beta. alpha. beta,"]
    want = [np.array(model.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encode(texts) == want
    assert asked.count("alpha") == 1 and asked.count("beta") == 1
