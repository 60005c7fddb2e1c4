from __future__ import annotations

import hashlib
import random

from odd import empty_table, odd_rows, odd_table

from geoledger.llm import merkle


def test_edits_are_located():
    rng = random.Random(1)
    parts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randint(0, 99)) for _ in range(30)) for _ in range(40)]
    one = "\n".join(parts)
    other = "\n".join([*parts[:17], "a new paragraph", *parts[18:]])
    a, b = merkle.fingerprint(one), merkle.fingerprint(other)
    assert merkle.differing(a, b) == ([17], [17]) and merkle.differing(a, a) == ([], [])
    assert 0.9 < merkle.likeness(a, b) < 1 == merkle.likeness(a, a)
    inserted = merkle.fingerprint("\n".join([*parts[:5], "one more", *parts[5:]]))
    assert merkle.differing(a, inserted) == ([], [5])


def test_neighbours_equal_a_plain_version(spark):
    rng = random.Random(5)
    rows = [(7 * i, " ".join(rng.choice(["alpha", "beta", "gamma\n", "delta"]) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    rows += [(None, "zz"), (None, None), (5, "dup"), (5, "dup"), (5, "other")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    hashes = {r[0]: r[1] for r in table.selectExpr("coalesce(text, '')", "xxhash64(coalesce(text, ''))").collect()}
    order = sorted(((k is not None, k or 0, hashes[t or ""]), k, t or "") for k, t in rows)
    expected = []
    for i, (_, key, text) in enumerate(order):
        following = order[(i + 1) % len(order)][2]
        changed = merkle.edited(text, following)
        a, b, c = map(merkle.fingerprint, (text, changed, following))
        expected.append((key, len(text), hashlib.sha256(changed.encode()).hexdigest(), a, b, merkle.likeness(a, b), merkle.likeness(a, c)))
    assert sorted(map(tuple, merkle.neighbours(table).collect()), key=repr) == sorted(expected, key=repr)


def test_edited_text_takes_the_first_half_of_the_next():
    assert merkle.edited("abcde", "XYZ") == "abcXY"
    assert merkle.edited("abcdef", "X") == "abcX"
    assert merkle.edited("", "X") == "" and merkle.edited("a", "X") == "a"


def test_odd_rows(spark):
    rows = merkle.neighbours(odd_table(spark)).collect()
    assert len(rows) == len(odd_rows())
    assert len({r["fingerprint"] for r in rows if r["doc_id"] in (6, 7)}) == 1
    assert merkle.neighbours(empty_table(spark)).count() == 0


def test_half_a_text_is_found_whatever_it_is_made_of():
    rng = random.Random(9)
    drawn = {
        "repeated word": "spam " * 500,
        "other word": "again and " * 40,
        "one character": "a" * 3000,
        "chinese": "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(700)),
        "base64": "".join(rng.choice("ABCDEFGHIJKLMNOPabcdefghijklmnop0123456789+/") for _ in range(5000)),
        "emoji": "".join(chr(rng.randint(0x1F600, 0x1F640)) for _ in range(200)),
        "short chinese": "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(10)),
        "short": "one two three four five six",
        "two words": "hello world",
    }
    following = "Quite another text of some words that stand behind it, " * 3
    for name, text in drawn.items():
        near = merkle.likeness(merkle.fingerprint(text), merkle.fingerprint(merkle.edited(text, following)))
        assert near > 0.1, name
        front = following[: len(following) // 2] + text[len(text) // 2 :]
        if len(text) > 300:
            assert merkle.likeness(merkle.fingerprint(text), merkle.fingerprint(front)) > 0.1, name
    changed = drawn["base64"][:100] + "!" + drawn["base64"][100:]
    assert merkle.likeness(merkle.fingerprint(drawn["base64"]), merkle.fingerprint(changed)) > 0.9


def test_segments_cover_the_text_in_whole_characters():
    rng = random.Random(3)
    for n in [0, 1, 7, 8, 9, 127, 128, 129, 1000]:
        for letters in ["a", "a ", "ab \n", "\n", " ", "né漢😀", "né漢😀 \n"]:
            text = "".join(rng.choice(letters) for _ in range(n))
            data = text.encode()
            ends = merkle.segment_ends(data)
            assert ends == sorted(ends) and ends[-1] == len(data) - 1
            starts = [0, *[e + 1 for e in ends[:-1]]]
            parts = [data[a : e + 1] for a, e in zip(starts, ends, strict=True)]
            assert "".join(p.decode() for p in parts) == text and max(map(len, parts)) <= merkle.MOST_BYTES
            assert sum(p.endswith(b"\n") for p in parts) == text.count("\n")


def test_long_texts_do_not_look_alike_by_chance():
    rng = random.Random(11)
    one, other = (" ".join(f"{rng.getrandbits(48):012x}" for _ in range(150_000)) for _ in range(2))
    a, b = merkle.fingerprint(one), merkle.fingerprint(other)
    assert merkle.leaves_of(a).total() > 15_000 and merkle.likeness(a, b) == 0
