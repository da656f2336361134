"""Conversation trie, vector codes and web archives against plain versions, and their defined results for awkward rows."""

import base64
import gzip
import hashlib
import json
import random
import re
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

from chronolake.llm import vector_codes as codes_module
from chronolake.llm import warc
from chronolake.llm.conversation_trie import _ends, conversation_trie
from chronolake.llm.vector_codes import _Cells, vector_codes
from chronolake.llm.warc import read_warc, write_warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- conversation trie ----------------------------------------------------------------------------


def trie_nodes(rows):
    """Nodes of the trie by a dictionary of all prefixes."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, digest, role, text))
    members, ends = defaultdict(list), defaultdict(list)
    for conv in own:
        own[conv].sort()
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - (abs(conv) % 20) * (1 if conv >= 0 else -1)
        whole = tuple(t[3:] for t in own.get(base, [])[:h] + turns[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(conv)
        ends[whole].append(conv)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, own_members in members.items():
        words = (len(own_members) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += words
            leaves[node[:d]] += not children[node]
    return {
        (
            min(m),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(m),
            children[node],
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, m in members.items()
    }


def talk(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def same_trie(spark, rows, **options):
    found = [tuple(r) for r in conversation_trie(talk(spark, rows), **options).collect()]
    assert len(found) == len(set(found))
    assert set(found) == trie_nodes(rows)


def test_trie_bursts_and_goes_on_over_pieces(spark):
    draw = random.Random(1)
    rows = []
    for conv in [*range(-30, 60), 1000]:
        for turn in range(draw.choice([1, 2, 3, 5, 9])):
            rows.append((conv, draw.choice([turn, turn, None]), draw.choice(["a", "b", None]), draw.choice(["x y", "z", None])))
    for conv in (500, 501, 503, 504, 506):  # long ones that share pieces and part late
        rows += [(conv, t, "u", f"w {t}") for t in range(13 - conv % 3)]
    same_trie(spark, rows, container=3, piece=4)


def test_trie_of_copies_nulls_and_very_long_conversations(spark):
    rows = [(conv, t, "u", f"turn {t}") for conv in range(0, 400, 20) for t in range(3)]  # equal ones
    rows += [(7, 0, "u", "word " * 200_000), (None, 0, "u", "of no conversation"), (None, None, None, None)]
    rows += [(3001, t, "u", f"t {t % 7}") for t in range(300)]  # several pieces, alone
    rows += [(5001, None, None, None)] * 50  # repeated rows are turns
    same_trie(spark, rows, piece=64)
    frame = talk(spark, rows[:200]).selectExpr("*", "1 AS conv", "2 AS head", "3 AS n", "4 AS words", "5 AS part", "6 AS row")
    assert {tuple(r) for r in conversation_trie(frame).collect()} == trie_nodes(rows[:200])
    assert conversation_trie(frame.limit(0)).count() == 0


def test_ends_of_many_conversations(spark):
    """A node at which many conversations end is cut over several ranges and blocks."""
    ended = spark.range(30_000).selectExpr("CAST(IF(id % 3 = 0, 'hot', concat('n', id % 50)) AS BINARY) AS nid", "id AS conv")
    groups = defaultdict(list)
    for i in range(30_000):
        groups[b"hot" if i % 3 == 0 else f"n{i % 50}".encode()].append(str(i))
    found = {bytes(r.nid): r.sha for r in _ends(ended).collect()}
    assert found == {k: hashlib.sha256(",".join(v).encode()).hexdigest() for k, v in groups.items()}


# --- vector codes ---------------------------------------------------------------------------------


def plain_codes(vectors, parts=4, entries=256, rounds=4):
    """Codes and errors by comparing every part with every entry; vectors as integers, in order of ids."""
    cut = vectors.reshape(len(vectors), parts, -1)
    book = cut[:entries].transpose(1, 0, 2).copy()

    def nearest(p):
        apart = ((cut[:, p, None, :] - book[p][None]) ** 2).sum(2)
        return apart.argmin(1), apart.min(1)

    for _ in range(rounds):
        moved = book.copy()
        for p in range(parts):
            index, _ = nearest(p)
            for e in np.unique(index):
                moved[p, e] = cut[index == e, p].sum(0) // (index == e).sum()
        book = moved
    found = [nearest(p) for p in range(parts)]
    codes = ["".join(f"{found[p][0][i]:02x}" for p in range(parts)) for i in range(len(vectors))]
    sha = hashlib.sha256(",".join(str(x) for x in book.ravel().tolist()).encode()).hexdigest()
    return codes, sum(e for _, e in found), sha


def test_vector_codes(spark, monkeypatch):
    monkeypatch.setattr(codes_module, "PAIRS", 50)
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(5, 8))
    real = [(centres[i % 5] + draw.normal(size=8) * 0.2).astype(np.float32) for i in range(400)]
    real[7], real[9] = real[3], real[3]  # repeated vectors: ties between entries
    rows = [(i, v.tolist(), None if i % 11 == 0 else i % 3) for i, v in enumerate(real)]
    bad = [(900, None, 1), (901, [1.0, None] + [0.0] * 6, 1), (902, [float("nan")] * 8, 1), (903, [float("inf")] * 8, 2)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int").repartition(3)
    frame = frame.selectExpr("*", "1 AS code", "2 AS own", "3 AS vec", "4 AS parts")
    codes, errors, sha = plain_codes(np.floor(1024 * np.array(real, dtype=np.float64)).astype(np.int64), entries=16)
    found = {r.vec_id: r for r in vector_codes(frame, entries=16).collect()}
    assert len(found) == 400
    for i in range(400):
        same = [k for k in range(400) if rows[k][2] == rows[i][2]]
        expected = (codes[i], int(errors[i]), int(errors[same].sum()), sha)
        assert (found[i].code, found[i].error, found[i].label_error, found[i].codebooks_sha256) == expected


def test_vector_codes_of_awkward_rows(spark):
    schema = "vec_id long, embedding array<float>, label string"
    rows = [(None, [1.0, 2.0, 3.0], None), (5, [1.0], "a"), (5, [1.0], "a"), (2, [], None), (3, [2e9, 0.0, 0.0, -2e9, 1.0], "b")]
    found = vector_codes(spark.createDataFrame(rows, schema)).orderBy("code").collect()
    assert len(found) == 5 and all(r.error == r.label_error == 0 for r in found)  # each is an entry of its own
    assert {r.vec_id for r in found} == {None, 2, 3, 5}
    assert len({r.code for r in found if r.vec_id == 5}) == 1
    assert vector_codes(spark.createDataFrame([], schema)).count() == 0
    assert vector_codes(spark.createDataFrame([(1, None, "a")], schema)).count() == 0
    with pytest.raises(Exception, match="2\\^61"):
        vector_codes(spark.createDataFrame([(1, [1e30], "a")], schema)).count()


@pytest.mark.parametrize("scale", [10, 10**9])  # doubles, and Python's integers
@pytest.mark.parametrize("step", [1, 7, 1000])
def test_grid_cells_never_change_the_result(scale, step):
    draw = np.random.default_rng(step)
    entries = draw.integers(-scale, scale, (40, 4))
    points = np.concatenate([draw.integers(-scale, scale, (300, 4)), entries[:10]])
    cells = _Cells(entries, step * scale // 10)
    for _ in range(2):  # new cells, and remembered ones
        index, error = cells.nearest(points)
        apart = ((points[:, None].astype(object) - entries[None].astype(object)) ** 2).sum(2)
        assert error.tolist() == apart.min(1).tolist()
        assert index.tolist() == [row.tolist().index(min(row)) for row in apart]


# --- web archives ---------------------------------------------------------------------------------


def sha1_32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def archived(spark, rows, folder, **options):
    archive = write_warc(pages_of(spark, rows), str(folder), **options)
    return archive, read_warc(spark, archive.folder, with_payload=True).collect()


def awkward_pages():
    rows = [(i, f"http://a.example/{i % 40}", f"<p>text {i % 25}</p>" * (i % 9 + 1)) for i in range(300)]
    rows += [(300, None, None), (301, "", ""), (302, "http://b/ü\r\nInjected: 1", ""), (None, "u", "alone"), (None, None, None)]
    rows += [(7, "twice", "same row")] * 3 + [(400, "long", "é🙂" * 700_000), (401, "end", "x\r\n\r\nWARC/1.1\r\n")]
    return rows


@pytest.mark.parametrize("least", [0, 40])
def test_warc_round_trip(spark, tmp_path, least):
    rows = awkward_pages()
    archive, found = archived(spark, rows, tmp_path / "w", least=least, shard_bytes=20_000, file_bytes=2_000)
    best = {}
    for page, _, html in rows:
        key = html or ""
        best[key] = max(best.get(key, -1), -1 if page is None else page)
    assert len(found) == len(rows)
    assert sorted((r.payload_digest, r.payload_bytes) for r in found) == sorted((sha1_32(h), len((h or "").encode())) for _, _, h in rows)
    responses = defaultdict(int)
    text_of = {sha1_32(h): h or "" for _, _, h in rows}
    for r in found:
        html = text_of[r.payload_digest]
        page = -1 if r.page_id is None else r.page_id
        if r.record_type == "response":
            responses[html] += 1
            assert r.payload.decode() == html and r.refers_to is None
            assert page == best[html] or len(html.encode()) < least
        else:
            assert len(html.encode()) >= least and r.payload is None
            assert (-1 if r.refers_to is None else r.refers_to) == best[html]
    for _, _, html in rows:
        if len((html or "").encode()) >= least:
            assert responses[html or ""] == 1
    # Several shards and files; every record is a gzip member with a well-formed head.
    files = sorted((tmp_path / "w").glob("*.warc.gz"))
    assert len({f.name.split("-")[1] for f in files}) > 1 and len(files) > 5
    listed = [json.loads(line) for line in (tmp_path / "w" / warc.MANIFEST).read_text().splitlines()]
    assert [x["name"] for x in listed] == [f.name for f in files]
    for f, entry in zip(files, listed):
        assert hashlib.sha256(f.read_bytes()).hexdigest() == entry["sha256"]
        records = gzip.decompress(f.read_bytes())
        assert records.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and records.endswith(b"\r\n\r\n")
        assert b"\nInjected" not in records
    assert archive.manifest.count() == len(files)
    assert not list((tmp_path / "w").glob("*.temporary"))


def test_warc_is_deterministic_and_ignores_lost_attempts(spark, tmp_path):
    rows = awkward_pages()
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "pages-00000-00000.warc.gz.0123.temporary").write_bytes(b"left by a lost task")
    first, _ = archived(spark, rows, tmp_path / "a", shard_bytes=20_000, file_bytes=2_000)
    draw = random.Random(2)
    draw.shuffle(rows)
    frame = pages_of(spark, rows).repartition(5)
    write_warc(frame, str(tmp_path / "b"), shard_bytes=20_000, file_bytes=2_000)
    names = [f.name for f in sorted((tmp_path / "a").glob("*.warc.gz"))]
    assert len(names) > 5
    for name in names:
        assert (tmp_path / "a" / name).read_bytes() == (tmp_path / "b" / name).read_bytes()
    assert read_warc(spark, str(tmp_path / "b")).count() == len(rows)
    with pytest.raises(FileExistsError):
        write_warc(frame, str(tmp_path / "b"))


def test_warc_hot_payload_empty_table_and_damage(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "MAX_COPIES", 5)
    monkeypatch.setattr(warc, "MAX_HOT", 10_000)
    rows = [(i, "u", "hot" if i % 3 == 0 else f"t{i % 60}") for i in range(300)]
    _, found = archived(spark, rows, f"file://{tmp_path}/hot")
    assert {r.refers_to for r in found if r.payload_digest == sha1_32("hot") and r.record_type == "revisit"} == {297}
    assert sum(r.record_type == "response" for r in found) == len({h for _, _, h in rows})
    _, none = archived(spark, [], tmp_path / "none")
    assert none == [] and (tmp_path / "none" / warc.MANIFEST).read_text() == ""
    with pytest.raises(Exception):
        read_warc(spark, str(tmp_path)).count()  # no manifest
    name = next(Path(tmp_path / "hot").glob("*.warc.gz"))
    name.write_bytes(name.read_bytes()[:-30])
    with pytest.raises(Exception):
        read_warc(spark, str(tmp_path / "hot")).count()


# --- very long texts ------------------------------------------------------------------------------


def test_packing_of_long_blank_runs(spark):
    from chronolake.llm.packing import Encoder, pack, tokenizer_files

    encoder = Encoder(*tokenizer_files())
    for text in ("a b" + " " * 20_000 + "c", "\n" * 12_000, "x" + "\t" * 11_000 + "y z"):
        assert encoder.ids(text) == encoder.fast.encode_ordinary(text)  # short enough for both libraries
    rows = [(1, " " * 1_000_000), (2, "ab" + "\n" * 1_000_000 + "cd"), (3, "ab")]
    found = pack(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} == {1, 2, 3}


def test_many_secrets_in_one_text(spark):
    from chronolake.llm.secrets import find_secrets

    hexes = [f"{i:024x}" for i in range(40_000)]
    text = " é ".join(hexes)
    rows = spark.createDataFrame([(1, text), (2, "token: abcdef123"), (3, None)], "doc_id long, text string")
    found = {r.doc_id: r.spans for r in find_secrets(rows).collect()}
    spans = [(s.start, s.end) for s in found[1] if s.kind == "hex"]
    assert spans == [(27 * i, 27 * i + 24) for i in range(40_000)]
    assert len(found[2]) == 1 and found[3] == []


def test_what_is_a_letter():
    from chronolake.llm.language import has_letter

    assert not any(map(has_letter, ["", "²", "½ ① 12 _", "٣"])) and all(map(has_letter, ["1é", "ª", "ñ", "字", "ʰ"]))


def test_scores_of_large_components(spark):
    from chronolake.llm.top_k import _products, top_k

    draw = np.random.default_rng(9)
    left, right = draw.integers(-1000, 1000, (6, 4)), draw.integers(-1000, 1000, (7, 4))
    left[2], right[3] = [2**40, 0, 5, 0], [0, 2**41, 7, 0]
    expected = left.astype(object) @ right.T.astype(object)
    assert _products(left, right).tolist() == expected.tolist()
    rows = [(0, [1e9, 0.0]), (1, [0.0, 1e9]), (2, [1.0, 1.0]), (3, [2.0, -1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in top_k(frame, lambda key: key < 3, k=1).collect()}
    assert found[0, 1] == (3, 1024 * 2 * 1024 * 10**9) and found[1, 1][0] == 2
    with pytest.raises(Exception, match="fit a long"):
        top_k(frame.unionByName(frame.where("vec_id = 0").selectExpr("7L AS vec_id", "embedding")), lambda key: key < 1).count()
