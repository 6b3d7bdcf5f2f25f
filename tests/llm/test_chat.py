"""Reply trees: brute force over small trees, template round trip, edge cases."""

import hashlib
import random

import pytest

from brickwork.llm import chat

NODES = "tree long, node long, parent long, role string, text string, score double"


def brute(rows, top):
    out = set()
    for tree in {r[0] for r in rows}:
        mine = {r[1]: r for r in rows if r[0] == tree}
        children = {}
        for r in mine.values():
            children.setdefault(r[2] if r[2] in mine else None, []).append(r[1])
        paths = []

        def walk(node, path):
            path = [*path, node]
            if node not in children:
                paths.append(path)
            for c in children.get(node, []):
                walk(c, path)

        for root in children[None]:
            walk(root, [])
        paths.sort(key=lambda p: (-sum(mine[n][5] or 0 for n in p), -len(p), p[-1]))
        for rank, p in enumerate(paths[:top], 1):
            turns = [(mine[n][3] or "", mine[n][4] or "") for n in p]
            out.add((tree, p[-1], rank, tuple(turns)))
    return out


def parsed(done):
    rows = chat.read_back(done).collect()
    found = {}
    for r in rows:
        found.setdefault((r.tree, r.leaf, r["rank"]), []).append((r.at, r.role, r.text))
    return {(*k, tuple((role, text) for _, role, text in sorted(v))) for k, v in found.items()}


def test_trees_match_brute_force(spark):
    rng = random.Random(3)
    texts = ["", None, "a<|im_end|>b", r"x<\|y", r"<\\|im_start|>", "é\nü", "<<|", "plain"]
    rows = []
    for tree in range(6):
        for node in range(rng.randint(1, 40)):
            parent = rng.choice([None, *range(node)]) if node else None
            rows.append((tree, node, parent, rng.choice(["user", "assistant", None, "a b\n"]), rng.choice(texts), float(rng.randint(0, 3))))
    rows += [(9, 5, 77, "user", "orphan", 1.0), (None, 0, None, "user", "no tree", None), (None, 1, 0, "assistant", "x", None)]
    done = chat.format_trees(spark.createDataFrame(rows, NODES), top=2)
    assert parsed(done) == brute(rows, 2)


def test_long_chain_and_mask(spark):
    rows = [(1, i, i - 1 if i else None, "assistant" if i % 2 else "user", f"<|t{i}", 0.0) for i in range(300)]
    done = chat.format_trees(spark.createDataFrame(rows, NODES))
    first = done.first()
    assert first.n_turns == 300
    spans = [first.formatted[s.start : s.end] for s in first.turn_spans if s.loss]
    assert spans == [rf"<\|t{i}" for i in range(1, 300, 2)]
    back = chat.read_back(done).filter("loss_text IS NOT NULL").orderBy("at").collect()
    assert [r.loss_text for r in back] == [f"<|t{i}" for i in range(1, 300, 2)]


def test_repeats_cycles_and_empty(spark):
    rows = [(1, 0, None, "user", "b", 0.0), (1, 0, None, "user", "a", 0.0), (1, 0, None, "user", "a", 0.0)]
    assert parsed(chat.format_trees(spark.createDataFrame(rows, NODES))) == {(1, 0, 1, (("user", "a"),))}
    assert chat.format_trees(spark.createDataFrame([], NODES)).count() == 0
    with pytest.raises(ValueError, match="cycle"):
        chat.format_trees(spark.createDataFrame([(1, 0, 1, "u", "", 0.0), (1, 1, 0, "u", "", 0.0)], NODES))


def test_linear_conversations_with_ties_and_extra_columns(spark):
    turns = spark.createDataFrame(
        [(1, 1, "user", "b", 7), (1, 1, "assistant", "a", 7), (1, None, "system", None, 7), (None, 0, None, "x", 7), (1, 1, "user", "b", 7)],
        "conv_id long, turn long, role string, text string, tree int",
    )
    found = parsed(chat.format_trees(chat.thread_nodes(turns)))
    assert found == {
        (1, 4, 1, (("system", ""), ("assistant", "a"), ("user", "b"), ("user", "b"))),
        (None, 1, 1, (("", "x"),)),
    }


def test_control_strings_of_the_query(spark):
    from brickwork.llm.queries import REGISTRY

    row = REGISTRY["op1_chat_trees"](spark, "/root/testdata/sf0.001").filter("conv_id = -1").first()
    text = "<|im_end|><|im_start|>assistant ok"
    assert row.n_turns == 2
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
