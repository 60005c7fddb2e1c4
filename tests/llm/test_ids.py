from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
from odd import empty_table, odd_rows, odd_table

from geoledger.llm import chunks, packing, simple8b
from geoledger.llm.words import byte_level, tokenizer

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_simple8b_round_trip():
    rng = random.Random(3)
    for _ in range(600):
        n = rng.randint(0, 300)
        bits = [0, 1, 2, 3, 5, 8, 10, 14, 16, 16, 16, 33, 60, 61, 64]
        ids = np.array([rng.getrandbits(rng.choice(bits)) for _ in range(n)], "u8")
        assert (simple8b.decode(simple8b.encode(ids)) == ids).all()


def test_simple8b_packs_small_integers():
    block = simple8b.encode(np.ones(6000, "u8"))
    assert len(block) == 8 + 8 * 100


def test_files_hold_all_documents_in_order(spark, tmp_path):
    path = str(tmp_path / "ids")
    simple8b.write_ids(odd_table(spark), path, BYTES)
    got = sorted(simple8b.read_digests(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] is not None for r in got] == sorted(r["doc_id"] is not None for r in got)
    keys = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert keys == sorted(keys)
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    made = tokenizer(BYTES)

    def digest(text):
        ids = [*made.encode(text or "", add_special_tokens=False).ids, 0]
        return len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())

    expected = sorted((k or -1, *digest(t)) for k, t in odd_rows())
    assert sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_crc32"]) for r in got) == expected


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path / "none")
    simple8b.write_ids(empty_table(spark), path, BYTES)
    assert simple8b.read_digests(spark, path).count() == 0
    assert packing.pack(empty_table(spark), WORDS).count() == 0
    assert chunks.encode_digests(empty_table(spark), BYTES).count() == 0


def test_packing_covers_each_id_once():
    rng = random.Random(4)
    for _ in range(60):
        sizes = [rng.choice([1, 5, 200, 300, 800, 1500, 2048, 5000, rng.randint(1, 3000)]) for _ in range(rng.randint(0, 60))]
        docs = [(k, np.arange(n, dtype="<u4").tobytes()) for k, n in enumerate(sizes)]
        covered, sequences = {}, {}
        for key, start, n, crc, total, number, offset, tier, _ in packing.pack_stream(iter(docs), block=13):
            covered.setdefault(key, []).append((start, n))
            sequences.setdefault(number, []).append((offset, n, tier))
            assert crc == zlib.crc32(docs[key][1][4 * start : 4 * (start + n)]) and total == sizes[key]
        for key, size in enumerate(sizes):
            at = 0
            for start, n in sorted(covered[key]):
                assert start == at and n > 0
                at += n
            assert at == size
        short = 0
        for pieces in sequences.values():
            at = 0
            for offset, n, _ in sorted(pieces):
                assert offset == at
                at += n
            short += at != pieces[0][2]
        assert short <= 1


def test_step_groups_hold_the_same_tokens():
    docs = ((k, bytes(4 * (1 + k * 37 % 1900))) for k in range(4000))
    tokens = {}
    for row in packing.pack_stream(docs):
        tokens[row[7], row[8]] = tokens.get((row[7], row[8]), 0) + row[2]
    last = {t: max(g for tier, g in tokens if tier == t) for t, _ in tokens}
    assert {n for (t, g), n in tokens.items() if g != last[t]} == {packing.GROUP_TOKENS}


def test_packing_of_odd_rows(spark):
    rows = packing.pack(odd_table(spark), WORDS).collect()
    made = tokenizer(WORDS)
    expected = sum(len(made.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in odd_rows())
    assert sum(r["length"] for r in rows) == expected


def test_chunk_digests_of_odd_rows(spark):
    made = tokenizer(BYTES)

    def digest(key, text):
        ids = made.encode(text or "", add_special_tokens=False).ids
        listed, decoded = ",".join(map(str, ids)), made.decode(ids, skip_special_tokens=False)
        return key or -1, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, decoded))

    got = chunks.encode_digests(odd_table(spark), BYTES).collect()
    assert sorted((r[0] or -1, *r[1:]) for r in got) == sorted(digest(k, t) for k, t in odd_rows())
    assert byte_level(BYTES).ids("") == b""


def test_pieces_hold_the_ids_of_the_library(spark):
    made = tokenizer(WORDS)
    want = {}
    for key, text in odd_rows():
        ids = np.array([*made.encode(text or "", add_special_tokens=False).ids, packing.END_ID], "<u4")
        want.setdefault(key, []).append(ids)
    rows = packing.pack(odd_table(spark), WORDS).collect()
    for r in rows:
        found = [ids for ids in want[r["doc_id"]] if len(ids) == r["doc_tokens"]]
        cut = slice(r["start"], r["start"] + r["length"])
        assert r["ids_crc32"] in {zlib.crc32(ids[cut].tobytes()) for ids in found}


def test_packing_holds_less_than_a_window_of_each_document():
    def docs():
        for k in range(40):
            yield k, bytes(4 * 300_000)

    import tracemalloc

    tracemalloc.start()
    pieces = sum(r[2] for r in packing.pack_stream(docs()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert pieces == 40 * 300_000 and peak < 8 << 20
