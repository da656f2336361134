"""Exact dedup, mixing and packing against plain versions, and their defined results for awkward rows."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from chronolake.llm.exact_dedup import exact_dedup
from chronolake.llm.mixing import mix, mixed_rows
from chronolake.llm.packing import Encoder, best_fit, pack, tokenizer_files, vocabulary_path


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("limit", [256, 1])  # 1: every text with copies is salted
def test_exact_dedup(spark, awkward, limit):
    found = exact_dedup(awkward, max_copies=limit).select("row.*", *_prefixed()).collect()
    groups = defaultdict(list)
    for r in awkward.collect():
        groups[lowered(r.text)].append(r.doc_id)
    assert len(found) == awkward.count()
    for r in found:
        ids = groups[lowered(r.text)]
        assert r.group_size == len(ids)
        assert r.o_keep == max((i for i in ids if i is not None), default=None)
        assert r.text_sha256 == hashlib.sha256(lowered(r.text).encode()).hexdigest()
    assert sum(r.o_kept for r in found) == len(groups)
    assert all(r.doc_id == r.o_keep for r in found if r.o_kept)


def _prefixed():
    from pyspark.sql import functions as F

    return [F.col("keep_id").alias("o_keep"), "group_size", F.col("kept").alias("o_kept"), "text_sha256"]


def test_exact_dedup_of_a_large_group(spark):
    rows = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'Same Text', concat('t', id)) AS text")
    found = exact_dedup(rows, keep_row=False).where("text_sha256 = sha2('same text', 256)")
    assert [tuple(r) for r in found.selectExpr("max(keep_id)", "min(group_size)", "sum(int(kept))").collect()] == [(2997, 1000, 1)]


def shared(sizes, weights=(1, 2, 3), most=3):
    """Share by weight, cut at the cap, share the excess again until no source is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, rest, left = dict.fromkeys(names, 0.0), float(sum(sizes.values())), set(names)
    while left:
        total = sum(weight[s] for s in left)
        full = [s for s in left if rest * weight[s] / total > most * sizes[s]]
        for s in full or left:
            target[s] = float(most * sizes[s]) if full else rest * weight[s] / total
        if not full:
            break
        rest -= sum(target[s] for s in full)
        left -= set(full)
    return target


def test_mix(spark, awkward):
    rows = awkward.unionByName(
        spark.range(100, 900).selectExpr(
            "id AS doc_id",
            "repeat('word ', int(1 + id % 37)) AS text",
            "'en' AS lang",
            "IF(id < 300, 'hot', IF(id < 310, 'tiny', concat('s', id % 5))) AS source",
            *[f"'clash' AS {c}" for c in awkward.columns[4:]],
        )
    )
    source = {r.doc_id: r.source for r in rows.collect()}
    found = mix(rows).collect()
    sizes = Counter()
    for r in rows.collect():
        sizes[r.source] += len((r.text or "").encode().split())
    target = shared(sizes)
    taken, longest = Counter(), Counter()
    for r in found:
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r["size"]
        if r.doc_id is None:
            continue
        assert r.source_size == sizes[source[r.doc_id]]
        assert math.isclose(r.target, target[source[r.doc_id]], rel_tol=1e-9, abs_tol=1e-9)
    by_id = {s: [r for r in found if r.doc_id is not None and source[r.doc_id] == s] for s in ("hot", "tiny", "s0")}
    for s, own in by_id.items():
        taken, longest = sum(r.taken for r in own), max(r["size"] for r in own)
        assert abs(taken - target[s]) <= longest
    again = {tuple(r) for r in mix(rows.repartition(5)).collect()}
    assert again == {tuple(r) for r in found}


def test_mixed_rows_repeat(spark):
    rows = spark.range(40).selectExpr("id AS doc_id", "'a b' AS text", "IF(id < 4, 'a', 'c') AS source")
    copies = {r.doc_id: r.copies for r in mix(rows).collect()}
    assert {r.doc_id: r["count"] for r in mixed_rows(rows).groupBy("doc_id").count().collect()} == {
        k: n for k, n in copies.items() if n
    }


def test_best_fit_counts():
    runs = best_fit({2048: 2, 1500: 3, 548: 2, 500: 5, 1: 100})
    places = [(r[4] + i // r[3], r[5] + i % r[3] * r[0], r[0]) for r in runs for i in range(r[2])]
    assert Counter(p[2] for p in places) == {2048: 2, 1500: 3, 548: 2, 500: 5, 1: 100}
    used = Counter()
    for sequence, offset, length in sorted(places):
        assert offset == used[sequence]
        used[sequence] += length
    assert max(used.values()) <= 2048 and sorted(used) == list(range(len(used)))
    assert sorted(used.values(), reverse=True)[:4] == [2048, 2048, 2048, 2048]


def test_both_libraries_give_the_same_ids():
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(vocabulary_path())
    exact.encode_special_tokens = True
    encoder = Encoder(*tokenizer_files())
    latin = [chr(c) for c in (*b"\t\n\r", *range(0x20, 0x7F), *range(0xA1, 0x250))]
    texts = ["".join(random.Random(i).choices(latin, k=200)) for i in range(200)]
    texts += ["", " ", "\r\n \n", "<|endoftext|> it's We'LL", "a\u00a0b\u2003c", "\x1c\x85 x", "\u4f60\u597d \u0661 \U0001f642"]
    assert all(encoder.ids(t) == exact.encode(t, add_special_tokens=False).ids for t in texts)


def test_pack(spark, awkward):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path())
    expected = Counter()
    for r in awkward.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
        first = (len(ids) - 1) % 2048 + 1
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for piece, (start, end) in enumerate(zip(cuts, cuts[1:])):
            crc = zlib.crc32(np.array(ids[start:end], dtype="<u4").tobytes())
            expected[(r.doc_id, piece, start, end - start, crc)] += 1
    found = pack(awkward).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    used = Counter()
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used[r.sequence_id]
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048
    assert len(used) == -(-sum(used.values()) // 2048)


def test_empty_tables(nothing):
    assert exact_dedup(nothing).count() == mix(nothing).count() == mixed_rows(nothing).count() == pack(nothing).count() == 0


def test_mixed_rows_of_null_and_repeated_ids(spark):
    """Every row has copies of its own: the sources give the words that the mix says."""
    rows = spark.range(90).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 7 ELSE id END AS doc_id",
        "concat(repeat('a ', int(id % 5)), 't', id) AS text",
        "concat('s', id % 2) AS source",
    )
    wanted = {}
    for r in mix(rows.selectExpr("text AS doc_id", "text", "source")).collect():
        wanted[r.source_size, r.target] = wanted.get((r.source_size, r.target), 0) + r.taken
    found = mixed_rows(rows).collect()
    assert sum(len(r.text.split()) for r in found) == sum(wanted.values())
    assert len({r.text for r in found if r.doc_id is None}) > 20
    assert len({r.text for r in found if r.doc_id == 7}) > 20
