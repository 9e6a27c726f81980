import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from corpora import no_docs, odd_docs
from tokenizers import Tokenizer

from weirgate.llm import packing


def best_fit(lengths, capacity):
    rooms = []
    for size in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= size]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - size)
        else:
            rooms.append(capacity - size)
    return len(rooms)


def test_plan_holds_every_piece_and_is_no_worse_than_best_fit():
    rng = random.Random(1)
    for _ in range(400):
        capacity = rng.choice([5, 10, 17, 64, 100])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 60))]
        plan = packing.plan(Counter(lengths), capacity)
        used = Counter()
        for kind, n in plan:
            assert sum(kind) <= capacity and n > 0
            for size in kind:
                used[size] += n
        assert used == Counter(lengths)
        assert sum(n for _, n in plan) <= best_fit(lengths, capacity)


def test_reduction_fixes_what_dominates():
    assert packing.plan({6: 1, 4: 1, 3: 1, 7: 1}, 10) and len(packing.plan({6: 1, 4: 1, 3: 1, 7: 1}, 10)) == 2
    counts = np.zeros(11, np.int64)
    counts[[3, 2]] = 1
    assert packing._dominant(counts, 10, 5) == (3, 2)
    counts[1] = 3
    assert packing._dominant(counts, 10, 5) is None
    assert packing._dominant(np.zeros(11, np.int64), 10, 5) == ()


def test_too_long_piece_is_refused():
    with pytest.raises(ValueError):
        packing.plan({11: 1}, 10)


@pytest.mark.parametrize("total", [1, 1023, 1024, 1025, 2048, 5000])
def test_cut(total):
    parts = packing.cut(total, 1024)
    assert [n for _, n in parts[1:]] == [1024] * (len(parts) - 1) and sum(n for _, n in parts) == total
    assert [s for s, _ in parts] == list(np.cumsum([0] + [n for _, n in parts])[:-1])


def check_packed(docs, packed):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter()
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or min(len(ids), 1024)
        edges = [0, *range(first, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(edges, edges[1:])):
            expected[doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == expected
    sequences = defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    lengths = [r.length for r in packed]
    assert len(sequences) <= best_fit(lengths, 1024)


def test_round_trip_of_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    check_packed([(r.doc_id, r.text) for r in docs.collect()], packing.pack(docs).collect())


def test_odd_rows(spark):
    docs = odd_docs(spark)
    check_packed([(r.doc_id, r.text) for r in docs.collect()], packing.pack(docs).collect())


def test_no_rows(spark):
    assert packing.pack(no_docs(spark)).count() == 0


def test_same_ids_as_the_vocabulary_file():
    encoder = packing.Encoder()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ["", "a<|endoftext|>b", " " * 5000, "\n" * 3000 + "x", "été  l'air ٣ \U0001f600", "x" * 20000, "\r\n\t don't 123"]:
        assert encoder.ids(text) == tokenizer.encode(text, add_special_tokens=False).ids
