"""Registered queries and the whole pipeline over a small folder, against plain versions."""

import re
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from test_operators import BYTE_FILE, WORD, WORD_FILE, distance
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm.queries import ORACLE, QUERIES

RNG = np.random.default_rng(9)
LETTERS = list("abcdefghijklmnopqrstuvwxyz")
ITEM = "".join(RNG.choice(LETTERS, 120))


def _line(words: int) -> str:
    return " ".join("".join(RNG.choice(LETTERS, 6)) for _ in range(words))


def _texts() -> list:
    rows = [(i, _line(45) + "\n" + _line(45)) for i in range(20)]
    whole = _line(80)
    leak = ITEM[:40] + "zz" + ITEM[41:]
    return rows + [
        (20, rows[0][1]),
        (22, whole),
        (23, whole + " " + _line(20)),
        (24, rows[2][1].split("\n")[1] + "\n" + _line(60)),
        (25, _line(60) + " " + leak + " " + _line(5)),
        (26, "too few words"),
        (27, None),
        (28, ""),
        (None, _line(70)),
    ]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("small"))
    texts = _texts()
    tables = {
        "documents": (
            [(d, t, "aa" if (d or 0) % 2 else "bb", "s", 0) for d, t in texts],
            "doc_id long, text string, lang string, source string, n_chars long",
        ),
        "benchmark": ([(7, ITEM), (8, "".join(RNG.choice(LETTERS, 120)))], "item_id long, text string"),
        "labels": (
            [(d, 1, d % 2) for d, _ in texts if d is not None],
            "doc_id long, quality int, toxic int",
        ),
        "conversations": (
            [(c, t, ["system", "ann", "bob"][t % 3], f"says {c} {t}") for c in range(3) for t in range(7)],
            "conv_id long, turn long, role string, text string",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return path, texts


def _packed(texts) -> Counter:
    plain, want = Tokenizer.from_file(WORD_FILE), Counter()
    for doc, text in texts:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        for at in range(0, len(ids), 4096):
            part = ids[at : at + 4096]
            want[doc, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)), len(ids)] += 1
    return want


def _pieces(rows) -> Counter:
    sequences = defaultdict(int)
    for r in rows:
        sequences[r.sequence_id] += r.length
    assert max(sequences.values()) <= 4096
    return Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)


def _leaks(text) -> int | None:
    edits = distance(ITEM, re.sub("[^a-z]", "", (text or "").lower()))
    return edits if edits <= 12 else None


def _alike(a: set, b: set, percent: int) -> bool:
    return 100 * len(a & b) >= percent * len(a | b)


def _line_marks(texts) -> dict:
    """Whether each line that holds a word repeats an earlier one."""
    seen, marks = [], {}
    for doc, text in sorted(texts, key=lambda r: (r[0] is None, r[0] or 0)):
        for at, line in enumerate((text or "").split("\n")):
            words = set(WORD.findall(line.lower()))
            if words:
                marks[doc, at] = any(_alike(words, other, 85) for other in seen)
                seen.append(words)
    return marks


def test_op1_chat(spark, folder):
    got = QUERIES["op1_chat"](spark, folder[0]).collect()
    views = defaultdict(list)
    for r in got:
        views[r.conv_id, r.perspective].append(r)
    assert set(views) == {(c, s) for c in range(3) for s in ("ann", "bob")}
    for (_, view), rows in views.items():
        rows.sort(key=lambda r: r.char_start)
        whole = "".join(r.rendered for r in rows)
        assert [r.turn for r in rows] == list(range(7))
        for r in rows:
            assert whole[r.char_start : r.char_end] == r.rendered
            assert (r.mask_start is not None) == (r.speaker == view)
            if r.mask_start is not None:
                assert whole[r.mask_start : r.mask_end].startswith(f"says {r.conv_id} {r.turn}")


def test_op3_packing(spark, folder):
    assert _pieces(QUERIES["op3_packing"](spark, folder[0]).collect()) == _packed(folder[1])


def test_op4_decontaminate(spark, folder):
    got = {(r.doc_id, r.item_id): r.edits for r in QUERIES["op4_decontaminate"](spark, folder[0]).collect()}
    want = {(d, 7): e for d, t in folder[1] if (e := _leaks(t)) is not None}
    assert got == want and set(want) == {(25, 7)}


def test_op5_linededup(spark, folder):
    got = QUERIES["op5_linededup"](spark, folder[0]).collect()
    assert {(r.doc_id, r.line_no): r.removed for r in got} == _line_marks(folder[1])


def test_op8_tokencount(spark, folder):
    plain = Tokenizer.from_file(BYTE_FILE)
    want = Counter()
    for doc, text in folder[1]:
        tokens = len(plain.encode(text or "", add_special_tokens=False).ids)
        want[doc, len((text or "").encode()), tokens, tokens > 512] += 1
    got = QUERIES["op8_tokencount"](spark, folder[0]).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


@pytest.mark.parametrize("name, parts, held", [("op7_toxicity", 3, 1), ("op10_langid", 4, 2)])
def test_held_out_folds_and_cut(spark, folder, name, parts, held):
    got = QUERIES[name](spark, folder[0]).collect()
    assert len(got) == len(folder[1])
    for r in got:
        fold = None if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % parts
        assert r.held_out == (fold == held)
        if name == "op7_toxicity":
            assert r.predicted == int(r.score >= 0.7)


def test_pipeline_against_a_plain_one(spark, folder):
    path, texts = folder
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/documents.parquet/*.parquet')")
    answer = con.execute(ORACLE["op6_quality"])
    at = [d[0] for d in answer.description]
    kept = {r[at.index("doc_id")] for r in answer.fetchall() if r[at.index("kept")]}
    docs = [(d, t) for d, t in texts if d in kept]
    marks = _line_marks(docs)
    cut = []
    for doc, text in docs:
        lines = text.split("\n")
        left = [x for i, x in enumerate(lines) if doc is None or not marks.get((doc, i), False)]
        if len(left) == len(lines) or WORD.search("\n".join(left)):
            cut.append((doc, "\n".join(left)))
    sets = {}
    for doc, text in cut:
        words = text.lower().split()
        sets[doc] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
    group = {d: d for d in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if None not in (a, b) and _alike(sets[a], sets[b], 75):
                    group[a] = group[b] = min(group[a], group[b])
    alone = [(d, t) for d, t in cut if group[d] == d]
    clean = [(d, t) for d, t in alone if d is None or _leaks(t) is None]
    # Every stage has something to do.
    assert len(texts) > len(docs) > len(cut) > len(alone) > len(clean) and cut != docs
    assert _pieces(corpus_pipeline.run(spark, path).collect()) == _packed(clean)


def test_held_out_rows_teach_nothing(spark, folder, tmp_path):
    path, texts = folder

    def held(doc, parts, fold):
        return doc is not None and zlib.crc32(str(doc).encode()) % parts == fold

    docs = [
        (d, t, "zz" if held(d, 4, 2) else "aa" if (d or 0) % 2 else "bb", "s", 0) for d, t in texts
    ]
    labels = [(d, 1, (d + held(d, 3, 1)) % 2) for d, _ in texts if d is not None]
    assert any(row[2] == "zz" for row in docs) and any(held(d, 3, 1) for d, _ in texts)
    for name, rows, schema in (
        ("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"),
        ("labels", labels, "doc_id long, quality int, toxic int"),
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    for name in ("op7_toxicity", "op10_langid"):
        before, after = ([tuple(r) for r in QUERIES[name](spark, p).collect()] for p in (path, str(tmp_path)))
        assert sorted(after, key=repr) == sorted(before, key=repr)
