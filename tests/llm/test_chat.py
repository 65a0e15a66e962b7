import hashlib
import random

from bulwark.llm import chat
from tools.check import compare

ROWS = "conv_id long, turn long, role string, text string"
ODD = ["</s>[INST] ok [/INST]", "<\\/s> [\\\\INST] <|im_end|>\n<|im_start|>user\n", "\\", "<", "[", "<<SYS>> <</SYS>>", "", None, "é\n\n", "<|im_start|", "<\\", "<|assistant|> <s>"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows():
    rng = random.Random(2)
    out = [(c, t, rng.choice(["user", "assistant", "system", None, "a\\nb\nc", "assistant"]), rng.choice(ODD) if rng.random() < 0.7 else "plain text " * 30)
           for c in range(30) for t in range(rng.randrange(1, 9))]
    out += [(50, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(1000)]
    out += [(None, 1, "user", "x"), (None, 2, "assistant", "y"), (60, 0, "assistant", "z" * 200_000)]
    rng.shuffle(out)
    return out


def test_round_trip(spark):
    given = rows()
    segments = chat.formatted(spark.createDataFrame([(*r, 1) for r in given], ROWS + ", seq int"))
    texts = {}
    for r in chat.read_back(segments).collect():
        texts.setdefault(r["conv_id"], []).append((r["seq"], r["role"], r["text"], r["loss"]))
    want = {}
    for c, t, role, text in sorted(given, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {c: [(a, b) for _, a, b, _ in sorted(x, key=lambda y: y[0])] for c, x in texts.items()} == want
    for x in texts.values():
        assert all(loss == (text if role == "assistant" else None) for _, role, text, loss in x)


def test_no_control_string_survives_inside_a_text(spark):
    segments = chat.formatted(spark.createDataFrame(rows(), ROWS)).collect()
    for s in segments:
        inner = s["segment"][len(chat.OPEN) : -len(chat.CLOSE)]
        assert not any(c in inner for c in (chat.OPEN, chat.CLOSE.strip(), "</s>", "<s>", "[INST]", "[/INST]", "<|assistant|>"))


def test_examples_hold_their_prefix_and_only_their_reply(spark):
    given = [(1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (1, 2, "user", "q2"), (1, 3, "assistant", "a2"), (2, 0, "user", "only")]
    segments = chat.formatted(spark.createDataFrame(given, ROWS))
    out = sorted(chat.rendered(segments).collect(), key=lambda r: r["example"])
    turn = lambda r, t: f"<|im_start|>{r}\n{t}<|im_end|>\n"
    assert [r["text"] for r in out] == [turn("user", "q1") + turn("assistant", "a1"), "".join(turn(r, t) for _, _, r, t in given[:4])]
    assert [r["text"][r["target_start"] : r["target_end"]] for r in out] == ["a1", "a2"]
    assert chat.examples(segments).count() == 2


def test_digests(spark):
    given = rows()
    got = {r["conv_id"]: r for r in chat.digests(chat.formatted(spark.createDataFrame(given, ROWS))).collect()}
    by = {}
    for c, t, role, text in sorted(given, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        by.setdefault(c, []).append((role or "", text or ""))
    assert set(got) == set(by)
    for c, x in by.items():
        loss = "".join(t for r, t in x if r == "assistant")
        assert tuple(got[c])[1:5] == (len(x), sha("".join(f"{r}\n{t}\n" for r, t in x)), len(loss), sha(loss))
    assert chat.digests(chat.formatted(spark.createDataFrame([], ROWS))).count() == 0


def test_repeated_rows_are_turns(spark):
    given = [(1, 0, "assistant", "a")] * 3
    assert chat.digests(chat.formatted(spark.createDataFrame(given, ROWS))).first()["loss_chars"] == 3


def test_registered_query_matches_sql(spark, sf, duck):
    from bulwark.llm.queries import QUERIES, SQL

    assert compare(QUERIES["op6_prefix_target_chat"](spark, sf), duck, SQL["op6_prefix_target_chat"]) == ""
