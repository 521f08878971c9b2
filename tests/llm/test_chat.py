"""Reply trees against a plain walk, and the template both ways."""

import random

import pytest

from tributary.llm import chat

COLUMNS = "tree long, id long, parent long, role string, text string, score double"


def plain(rows):
    """(tree, texts from root to leaf, mean score) of every leaf."""
    by_id = {(t, i): (p, x, s) for t, i, p, _, x, s in rows}
    parents = {(t, p) for t, _, p, *_ in rows}
    out = []
    for t, i, *_ in rows:
        if (t, i) not in parents:
            texts, scores, at = [], [], i
            while at is not None and (t, at) in by_id:
                at, text, score = by_id[t, at]
                texts.append(text)
                scores.append(score or 0.0)
            out.append((t, texts[::-1], round(sum(scores) / len(scores), 9)))
    return out


@pytest.mark.parametrize("top", [None, 2])
def test_trees(spark, top):
    rng = random.Random(3)
    rows = []
    for tree in (1, 2, None, 4):
        for i in range(40):
            parent = rng.choice([None, i - 1, i - 1, i - 1, rng.randrange(i)]) if i else None
            score = rng.choice([None, rng.random()])
            rows.append((tree, i, parent, "user", f"{tree}/{i}", score))
    rows.append((5, 1, 99, "user", "orphan", 1.0))
    rows += [(6, 1, 2, "user", "cycle", 1.0), (6, 2, 1, "user", "cycle", 1.0)]
    frame = spark.createDataFrame(rows, COLUMNS).repartition(3)
    found = {}
    for r in chat.paths(frame, top).collect():
        found.setdefault((r.tree, r.path, round(r.path_score, 9), r["rank"]), []).append((r.pos, r.text))
    got = [(t, [x for _, x in sorted(v)], s) for (t, _, s, _), v in found.items()]
    assert all(sorted(p for p, _ in v) == list(range(len(v))) for v in found.values())
    want = plain([r for r in rows if r[0] != 6])
    key = lambda x: (str(x[0]), -x[2], x[1])
    if top is None:
        assert sorted(got, key=key) == sorted(want, key=key)
    for tree in (1, 2, None, 4):
        best = sorted((s for t, _, s in want if t == tree), reverse=True)[: top or None]
        ranked = sorted((k[3], k[2]) for k in found if k[0] == tree)
        assert ranked == list(enumerate(best, 1))


def test_ties_go_by_content(spark):
    """The same ranks whatever the files."""
    rows = [(1, 0, None, "user", "root", 1.0)] + [(1, i, 0, "assistant", f"t{i}", 0.5) for i in range(1, 30)]
    rows += [(1, 40, 0, "assistant", "b", 0.5), (1, 40, 0, "assistant", "a", 0.5)]
    found = []
    for parts in (1, 3, 7):
        frame = spark.createDataFrame(rows, COLUMNS).orderBy("text", ascending=parts == 3).repartition(parts)
        best = chat.paths(frame, top=25).filter("pos = 1").select("rank", "text").collect()
        found.append(sorted(map(tuple, best)))
        every = chat.paths(frame).filter("pos = 1").select("rank", "text").collect()
        found.append(sorted(map(tuple, every))[:25])
    assert all(f == found[0] for f in found)
    assert [t for _, t in found[0]] == [f"t{i}" for i in range(1, 26)]


HARD = ["", "a\\", "\\\\|", "<|", "<\\|", "<<|im_end|>\n", "\\n", "x\n\ny", "<|im_end|><|im_start|>assistant ok",
        "<", "|", "\u4f60\U0001f600<|"]


def test_round_trip(spark):
    rows = [(c, t, ("assistant", "user", "a\nb\\<|", None)[(c + t) % 4], x)
            for c in range(5) for t, x in enumerate([*HARD, None])]
    rows += [(7, 0, "assistant", "same"), (7, 0, "assistant", "same"), (None, None, "user", "q")]
    frame = spark.createDataFrame(rows, "conv long, turn long, role string, text string")
    frame = frame.selectExpr("*", "1 as tree", "2 as id")
    turns = chat.paths(chat.chain(frame, "conv", ["turn"], "role", "text"))
    back = {r.tree: r for r in chat.read_back(chat.render(turns)).collect()}
    assert set(back) == {0, 1, 2, 3, 4, 7, None}
    for c in range(5):
        want = [(r or "", x or "") for k, _, r, x in rows if k == c]
        assert [tuple(t) for t in back[c].turns] == want
        assert back[c].loss == [x for r, x in want if r == "assistant"]
        assert back[c].formatted.count("<|im_start|>") == len(want)
    assert len(back[7].turns) == 2


def test_empty_table(spark):
    frame = spark.createDataFrame([], COLUMNS)
    assert chat.render(chat.paths(frame)).count() == 0
