"""Operators 5, 6 and 7: files, packing, shards."""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm.helpers import CASES, cases, documents, words
from voxlens.llm import id_files, packing, rans, sharding
from voxlens.llm.common import ready
from voxlens.llm.word_ids import WordIds


@pytest.fixture(scope="module")
def sp(spark):
    return ready(spark)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def library_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [1]


def test_word_ids_equal_the_library(library):
    own = WordIds(public_tokenizers.path("word_bpe_49k.json"), remembered=30)
    rng = random.Random(2)
    alphabet = "abzABZ'sdtrevml.,!?<|>0195éÉßÿŸñÑÆæøØİıſŉ×÷ªºŒžǅ日é \n\t\x1c 😀"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(2000)]
    texts += ["a<|endoftext|>b <|startoftext|>", "don't we'll I'M 'S", "ＦＵＬＬ ﬁ Å ΑΣ Σ", None, ""] + [t for _, t in CASES]
    for at in range(0, len(texts), 100):
        part = texts[at:at + 100]
        assert [np.frombuffer(b, "<u2").tolist() for b in own.encode(part)] == \
            [library_ids(library, t)[:-1] for t in part]


def test_pieces_met_as_words_are_not_merged_again(library):
    class Refusing:
        def tokenize(self, piece):
            raise AssertionError(f"merged again: {piece}")

    own = WordIds(public_tokenizers.path("word_bpe_49k.json"))
    own.encode(["inserate . , 7 été"])
    own.model = Refusing()
    for text in ("INSERATE. Inserate, 7inserate.", "Été, ÉTÉ."):
        assert np.frombuffer(own.encode([text])[0], "<u2").tolist() == library_ids(library, text)[:-1]


@pytest.mark.parametrize("n", [0, 1, 5, 511, 513, 70_000])
def test_rans_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n) - 1, 49_407).astype(np.uint16)
    tables = rans.Tables(rans.scaled(np.bincount(ids, minlength=1 << 16)))
    assert int(tables.freq.sum()) == 1 << rans.BITS
    block = rans.encode(ids, tables)
    assert (rans.decode(block, tables) == ids).all()
    if n == 70_000:
        size = rans.LANES * rans.STRIDE
        assert (rans.segment(block, tables, 1) == ids[size:2 * size]).all()
        assert len(block) < 2 * n
        for at in (5, len(block) // 2, len(block) - 1):  # a header field, the middle, the end
            with pytest.raises(Exception):
                rans.decode(block[:at] + bytes([block[at] ^ 255]) + block[at + 1:], tables)


def test_scaled_keeps_rare_ids():
    freq = rans.scaled(np.concatenate([np.ones(49_000), [10 ** 9] * 3, [0]]))
    assert int(freq.sum()) == 1 << rans.BITS and freq[:-1].min() == 1 and freq[-1] == 0


def expected_files(library, rows):
    out, at = Counter(), 0
    keyed = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for doc_id, text in keyed:
        ids = library_ids(library, text)
        out[doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4"))] += 1
        at += len(ids)
    return out


def test_id_files(sp, library):
    rows = [(i, words(i, 1 + i % 50)) for i in range(200)] + [(500, None), (501, ""), (502, CASES[11][1])]
    random.Random(1).shuffle(rows)
    docs = documents(sp, rows, extra=True).repartition(5)
    got = Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in id_files.round_trip(docs).collect())
    assert got == expected_files(library, rows)
    assert id_files.round_trip(docs.limit(0)).count() == 0
    repeated = id_files.round_trip(cases(sp)).collect()  # repeated and missing ids: gapless all the same
    assert sum(r.n_tokens for r in repeated) == max(r.start + r.n_tokens for r in repeated)
    assert sorted(r.n_tokens for r in repeated) == sorted(len(library_ids(library, t)) for _, t in CASES)


def test_damaged_files_are_noticed(sp):
    from pyspark.sql import functions as F

    from voxlens.session import stage_root

    path = f"{stage_root(sp)}/damaged"
    id_files.write(documents(sp, [(i, words(i, 30)) for i in range(50)]), path)
    blocks = sp.read.parquet(f"{path}/blocks")
    bad = blocks.withColumn("payload", F.concat(F.expr("substring(payload, 1, length(payload) - 1)"), F.unhex(F.lit("FF"))))
    bad.write.parquet(f"{path}2/blocks")
    sp.read.parquet(f"{path}/table").write.parquet(f"{path}2/table")
    with pytest.raises(Exception, match="damaged"):
        id_files.read(sp, f"{path}2").count()


def naive_best_fit(lengths, capacity):
    rooms: list[int] = []
    for n in sorted(lengths, reverse=True):
        at = bisect_left(rooms, n)
        room = rooms.pop(at) if at < len(rooms) else capacity
        insort(rooms, room - n)
    return len(rooms)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(3)
    for _ in range(150):
        capacity = rng.choice([8, 20, 100, 4096])
        lengths = [min(capacity, max(1, int(rng.expovariate(3 / capacity)))) for _ in range(rng.randrange(300))]
        histogram, fill, ranks = Counter(lengths), {}, Counter()
        plan = packing.best_fit_plan(histogram, capacity)
        for length, rank, count, per, first, offset in plan:
            assert rank == ranks[length]
            ranks[length] += count
            for k in range(count):
                fill.setdefault(first + k // per, []).append((offset + k % per * length, length))
        assert ranks == histogram and len(fill) == naive_best_fit(lengths, capacity)
        for own in fill.values():
            assert check_gapless(own) <= capacity


def check_gapless(own):
    at = 0
    for offset, length in sorted(own):
        assert offset == at
        at += length
    return at


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing(sp, library, capacity):
    rows = [(i, words(i, 1 + i % 90)) for i in range(150)] + CASES
    out = packing.pack(documents(sp, rows, extra=True).repartition(4), capacity).collect()
    want = Counter()
    for doc_id, text in rows:
        ids = np.array(library_ids(library, text), "<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            own = ids[start:start + capacity]
            want[doc_id, piece, start, len(own), zlib.crc32(own)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    sequences: dict[int, list] = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(check_gapless(s) <= capacity for s in sequences.values())
    assert len(sequences) == naive_best_fit([r.length for r in out], capacity)
    assert packing.pack(documents(sp, []), capacity).count() == 0


def shard_rows(out):
    by: dict[int, list] = {}
    for r in out:
        by.setdefault(r.shard, []).append(r)
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return by


def test_sharding_keeps_groups_and_sizes(sp):
    rows = [(i, words(i, 20 + i % 60)) for i in range(1500)]
    rows += [(2000 + i, words(i % 40, 20 + i % 40 % 60)) for i in range(400)]  # groups of about ten
    out = sharding.shard(documents(sp, rows, extra=True)).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter(
        (i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in rows)
    by = shard_rows(out)
    sizes = [sum(r.size for r in by.get(s, [])) for s in range(16)]
    assert max(sizes) - min(sizes) < 0.05 * sum(sizes) / 16
    assert {(r.law, r.grown_shard) for r in out} == {("bytes", None)}
    text, place = dict(rows), {}
    for r in out:
        place.setdefault(text[r.doc_id], Counter())[r.shard] += 1
    groups = [c for c in place.values() if sum(c.values()) > 1]
    together = sum(max(c.values()) for c in groups) / sum(sum(c.values()) for c in groups)
    assert together > 0.95


def test_sharding_splits_a_group_that_no_shard_holds(sp):
    rows = [(i, words(1, 50)) for i in range(600)] + [(1000 + i, words(i, 50)) for i in range(600)]
    by = shard_rows(sharding.shard(documents(sp, rows)).collect())
    sizes = [sum(r.size for r in by.get(s, [])) for s in range(16)]
    assert max(sizes) - min(sizes) < 0.15 * sum(sizes) / 16
    hot = Counter(s for s, own in by.items() for r in own if r.doc_id < 1000)
    assert len(hot) < 16 or max(hot.values()) > 2 * min(hot.values())


def whole_share(out, text) -> float:
    """Share of the groups of equal texts that lie in one shard."""
    place: dict[str, list[int]] = {}
    for r in out:
        place.setdefault(text[r.doc_id], []).append(r.shard)
    groups = [own for own in place.values() if len(own) > 1]
    return sum(len(set(own)) == 1 for own in groups) / len(groups)


@pytest.mark.parametrize("copies, linked", [(2, 2400), (20, 2160)])
def test_sharding_of_copies_mostly(sp, copies, linked):
    rows = [(i, words(i // copies if i < linked else i, 40)) for i in range(2400)]
    out = sharding.shard(documents(sp, rows)).collect()
    sizes = [sum(r.size for r in own) for own in shard_rows(out).values()]
    assert len(sizes) == 16 and max(sizes) - min(sizes) < 0.05 * sum(sizes) / 16
    assert whole_share(out, dict(rows)) > 0.9


def test_sharding_fills_shard_after_shard(sp):
    rows = [(i, words(-1 if i % 3 == 0 else i // 6 if i < 1200 else i, 40)) for i in range(2400)]
    out = sharding.shard(documents(sp, rows)).collect()
    hot = {r.shard for r in out if r.doc_id % 3 == 0}
    quota = sum(r.size for r in out) / 16
    assert len(hot) <= -(-sum(r.size for r in out if r.doc_id % 3 == 0) // quota) + 1
    text = dict(rows)
    assert whole_share([r for r in out if r.doc_id % 3], text) > 0.95


def test_sharding_asks_elsewhere_when_a_shard_is_full(sp):
    held = [[9] + [0] * 15] * 64  # all groups ask for the first shard
    groups = sp.createDataFrame([(i, 10, h) for i, h in enumerate(held)], "gid long, s long, held array<long>")
    load = [0.0] * 16
    parts = sharding.propagate(groups, 16, load, 50.0)
    got = Counter(r.shard for part in parts for r in part.collect())
    assert sum(got.values()) == 64 and max(got.values()) <= 5
    assert load == [10.0 * got[t] for t in range(16)]


def test_sharding_cases(sp):
    out = sharding.shard(cases(sp)).collect()
    shard_rows(out)
    assert sorted((r.size, r.text_crc32) for r in out) == sorted(
        (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in CASES)
    assert sharding.shard(documents(sp, [])).count() == 0


def test_segments_decode_side_by_side(monkeypatch):
    """Segments of a block are decoded several at a time, with the ids that each gives alone."""
    rng = np.random.default_rng(8)
    for n in (16 * 3 * 20, 16 * 3 * 20 + 5, 16 * 3 * 8 - 1, 7):
        ids = np.minimum(rng.zipf(1.3, n), 400).astype("<u2")
        tables = rans.Tables(rans.scaled(np.bincount(ids, minlength=500)))
        block, runs, steps = rans.encode(ids, tables, lanes=16, stride=3), [], rans._steps
        segments = rans.header(block)["segments"]
        alone = [rans.segment(block, tables, k) for k in range(segments)]
        monkeypatch.setattr(rans, "_steps", lambda block, tables, h, ks: runs.append(ks) or steps(block, tables, h, ks))
        assert (rans.decode(block, tables) == ids).all() and (np.concatenate(alone) == ids).all()
        monkeypatch.setattr(rans, "_steps", steps)
        assert sorted(k for ks in runs for k in ks) == list(range(segments)) and len(runs) <= segments // 8 + 2
