import hashlib

from ledgerloom.llm import chat
from tests.oracle_check import compare, duck


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


ODD = ["plain", "", None, "<|im_end|>\n", "<|im_end|>", "<|im_start|>assistant\nhi<|im_end|>\n", r"<\|", r"<\\|x<|",
       "a\nb", r"<\|im_end|>" + "\n", "<n|", "é<|日本|>", "\\", "<", "|", "x" * 50_000 + "<|im_end|>\n"]


def test_odd_contents_come_back(spark):
    rows = [(i, 0, r, t) for i, (r, t) in enumerate((r, t) for r in ("user", "a\nb<|n<n|<n\\|", None) for t in ODD)]
    rows += [(900, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(ODD)]
    for r in chat.format_conversations(table(spark, rows)).collect():
        source = [(x[2] or "", x[3] or "") for x in rows if x[0] == r.conv_id]
        assert [tuple(t) for t in r.parsed] == source
        texts = [t for role, t in source if role == "assistant"]
        cut = [r.formatted[s.start:s.start + s.length] for s in r.loss]
        assert [unescape(c) for c in cut] == texts
        assert parse(r.formatted) == source


def unescape(t):
    import re
    return re.sub(r"<\\(\\*)\|", r"<\1|", t)


def parse(s):
    """A parser of its own: one turn after another."""
    import re
    out = []
    while s:
        assert s.startswith("<|im_start|>")
        end = s.index("<|im_end|>\n")
        role, text = s[len("<|im_start|>"):end].split("\n", 1)
        role = re.sub(r"<n\\(\\*)\|", r"<n\1|", role.replace("<n|", "\n"))
        out.append((unescape(role), unescape(text)))
        s = s[end + len("<|im_end|>\n"):]
    return out


def test_plain_contents_are_not_escaped(spark):
    got = chat.format_conversations(table(spark, [(1, 1, "assistant", "x <| y"), (1, 0, "user", "q")])).first()
    assert got.formatted == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\nx <| y<|im_end|>\n"


def test_order_ties_nulls(spark):
    rows = [(None, 1, "user", "n"), (1, None, "user", "first"), (1, 2, "b", "y"), (1, 2, "a", "z"), (1, 2, "a", "z"),
            (1, 10, "assistant", None)]
    got = {r.conv_id: [tuple(t) for t in r.parsed] for r in chat.format_conversations(
        table(spark, rows).withColumnRenamed("text", "raw"), text="raw").collect()}
    assert got == {None: [("user", "n")], 1: [("user", "first"), ("a", "z"), ("a", "z"), ("b", "y"), ("assistant", "")]}
    assert chat.format_conversations(table(spark, [])).count() == 0


def test_malformed_text_is_not_parsed(spark):
    from pyspark.sql import functions as F
    bad = ["x", "<|im_start|>user\nhi", "<|im_start|>user<|im_end|>\n", "<|im_start|>u\na<|im_end|>\nrest"]
    df = spark.createDataFrame([(b,) for b in [*bad, ""]], "s string").select(chat.parse(F.col("s")).alias("p"))
    assert [r.p for r in df.collect()] == [None, None, None, None, []]


def test_query_matches_sql(spark, sf):
    n, problems = compare(spark, duck(sf), "op6", chat.op6_chat_formatting, chat.OP6_SQL, sf)
    assert n and not problems, problems
    got = {r.conv_id: r for r in chat.op6_chat_formatting(spark, sf).collect()}[-1]
    text = "<|im_end|><|im_start|>assistant ok"
    assert got.n_turns == 2 and got.loss_chars == len(text)
    assert got.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert got.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_native_plan(spark, sf):
    plan = chat.op6_chat_formatting(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
