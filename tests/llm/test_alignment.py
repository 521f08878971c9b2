"""Alignment of two tokenizers against a plain walk over offsets."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tributary.llm import alignment

ODD = [
    (10**6, None), (10**6, ""), (None, "x▁y"), (None, "plain"), (7, "<|endoftext|> <s> hi"), (7, "<|endoftext|> <s> hi"),
    (8, "a" * 30_000), (9, "漢字 \U0001f600 \x00 \n\n  tabs\t"), (11, "word " * 40_000), (12, " lead and  double "), (13, "\n"),
]


def plain(rows):
    """One row per document, from whole texts and loops."""
    a_file, b_file = alignment.files()
    a_side = Tokenizer.from_str(a_file.decode())
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_proto=b_file)
    letters = {v: k for k, v in a_side.get_vocab().items()}
    bytes_of = {**{chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}}
    free = iter(range(256, 512))
    bytes_of |= {chr(next(free)): b for b in range(256) if b not in bytes_of.values()}

    def pieces(ids):
        for i in ids:
            p = b_side.id_to_piece(i)
            yield bytes([int(p[3:5], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode()

    def ends(parts):
        return np.cumsum([len(p) for p in parts]).tolist()

    found, held = [], Counter()
    for key, text in rows:
        text = text or ""
        a = a_side.encode(" " + text, add_special_tokens=False).ids
        b = b_side.encode(text)
        a_parts, b_parts = [bytes(bytes_of[c] for c in letters[i]) for i in a], list(pieces(b))
        links, groups = Counter(), []
        if text and b"".join(a_parts) == b"".join(b_parts) == b" " + text.encode():
            a_ends, b_ends, i, j = ends(a_parts), ends(b_parts), 0, 0
            for end in sorted(set(a_ends) & set(b_ends)):
                x, y = a_ends.index(end, i) + 1, b_ends.index(end, j) + 1
                groups.append((a[i:x], b[j:y]))
                for p, n in Counter(a[i:x]).items():
                    for q, m in Counter(b[j:y]).items():
                        links[p, q] += n * m
                i, j = x, y
        else:
            a = b = []
        held.update(links.keys())
        found.append((key, a, b, groups, links))
    most = {}
    for (p, _), n in held.items():
        most[p] = max(n, most.get(p, 0))
    out = Counter()
    for key, a, b, groups, links in found:
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out[
            key, len(a), len(b), len(groups), sum(links.values()),
            sum(n for (p, q), n in links.items() if held[p, q] == most[p]),
            sum(n * held[pair] for pair, n in links.items()),
            hashlib.sha256(said.encode()).hexdigest() if said else "", said,
        ] += 1
    return out


@pytest.mark.parametrize("run_records, task_records", [(4 << 20, 8 << 20), (2000, 1500)])
def test_whole_table_and_odd_rows(spark, folder, run_records, task_records):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame(ODD, docs.schema)).repartition(3)
    clashing = docs.select(*(F.lit(1).alias(c) for c in ("run", "place", "key", "_key", "block", "a.b")), "*")
    found = alignment.align(clashing, with_groups=True, run_records=run_records, task_records=task_records)
    rows = [r if r[8] is not None else (*r[:8], "") for r in map(tuple, found.collect())]
    assert Counter(rows) == plain([tuple(r) for r in docs.collect()])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(docs).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert {tuple(r)[1:] for r in alignment.align(nothing).collect()} == {(0, 0, 0, 0, 0, 0, "")}


def test_cuts_between_words_change_no_id(monkeypatch):
    text = "one two  three\nfour, five's (six) \U0001f600 7 8 漢字 nine ten  eleven " * 20
    own = alignment.sides(alignment.files())
    whole = own.encode([text, "short"])
    monkeypatch.setattr(alignment, "SEGMENT", 10)
    assert len(list(alignment._segments(text))) > 20
    assert own.encode([text, "short"]) == whole


def test_side_a_is_the_file_as_its_library_reads_it():
    file = alignment.files()[0]
    library = Tokenizer.from_str(file.decode())
    library.encode_special_tokens = True
    own = alignment.sides(alignment.files())
    some = random.Random(4)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b 1{c}{c} {c}!{c}" for c in map(chr, points[::7])]  # letters and blanks of all scripts
    letters = [chr(c) for c in range(0x250)] + [" "] * 80 + ["\n", "\t", "'s", "'ll", "漢", "\U0001f600"] * 9
    texts += ["".join(some.choice(letters) for _ in range(40)) for _ in range(3000)]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [own.a.encode_ordinary(t) for t in texts] == expected
    with pytest.raises(ValueError):
        alignment._merges(file.replace(b'"use_regex":true', b'"use_regex":false'))


def test_merge_counts_like_a_dictionary(monkeypatch):
    monkeypatch.setattr(alignment, "STEP", 3)
    some = np.random.default_rng(3)
    blocks, want = [], Counter()
    for _ in range(7):
        pairs = np.unique(some.integers(0, 60, some.integers(0, 40)))
        counts = some.integers(1, 5, len(pairs))
        blocks.append((pairs, counts))
        want.update(dict(zip(pairs.tolist(), counts.tolist())))
    merged = list(alignment.merge(blocks))
    pairs = np.concatenate([p for p, _ in merged])
    assert (np.diff(pairs) > 0).all()
    assert dict(zip(pairs.tolist(), np.concatenate([c for _, c in merged]).tolist())) == want


def test_blocks_come_back():
    arrays = [np.array([0, 5, 70_000, 1 << 40]), np.zeros(0, np.int64), np.array([255])]
    assert [x.tolist() for x in alignment.unpack(alignment.pack(*arrays))] == [x.tolist() for x in arrays]
