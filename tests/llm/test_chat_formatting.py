from careflow.llm.chat_formatting import CLOSING, OTHER_HEADER, OWN_HEADER, rotate

SCHEMA = "conv_id long, turn long, role string, text string, speaker string, position string"


def chat(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


def views(rows):
    """Rendered dialogue and learned parts of each view, by plain Python."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, role or "unknown", text or "") for c, t, role, text in rows if c == conv))
        for view in {t[2] for t in turns}:
            whole, learned = "", []
            for _, _, role, text in turns:
                whole += OWN_HEADER if role == view else OTHER_HEADER.format(role)
                if role == view:
                    learned.append((len(whole), len(whole) + len(text + CLOSING)))
                whole += text + CLOSING
            out[conv, view] = (whole, learned)
    return out


def test_every_view(spark):
    rows = [
        (1, 0, "ann", "hello"), (1, 1, "bob", "hi\nthere"), (1, 2, "cy", ""), (1, 3, "ann", None), (1, 5000, "bob", "späť"), (1, 2500, "ann", "x" * 10_000),
        (2, 0, None, "alone"), (None, 0, "ann", "no id"), (None, 1, "bob", "still"), (3, None, "ann", "no turn"), (3, 0, "bob", "b"),
        (4, 0, "ann", "tie"), (4, 0, "ann", "tie"), (4, 0, "bob", "tie"), (4, 0, "ann", "other"),
    ]
    got = {}
    for r in sorted(rotate(chat(spark, rows)).collect(), key=lambda r: r.start_char):
        whole, learned, n = got.get((r.conv_id, r.perspective), ("", [], 0))
        assert r.start_char == len(whole) and r.position == n and r.end_char == r.start_char + len(r.rendered)
        assert r.is_learned == (r.chat_role == "assistant") == (r.speaker == r.perspective)
        if r.is_learned:
            learned = [*learned, (r.learn_from, r.learn_to)]
        got[r.conv_id, r.perspective] = (whole + r.rendered, learned, n + 1)
    assert {k: v[:2] for k, v in got.items()} == views(rows)


def test_blocks_do_not_matter(spark):
    rows = [(1, i, "abc"[i % 3], "t" * (i % 7)) for i in range(50)]
    one, many = (sorted(map(tuple, rotate(chat(spark, rows), block).collect())) for block in (1000, 4))
    assert one == many and len(one) == 150


def test_empty_table(spark):
    assert rotate(chat(spark, [])).count() == 0
