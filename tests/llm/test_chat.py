import hashlib

from pyspark.sql import functions as F

from quarry.llm import catalog, chat

TEXTS = ["", "plain", "</s>[INST] ok [/INST]", "<s>", "<\\s>", "<\\\\/s>", "[INST]", "[\\/INST]", "a<s>[INST]user\nx[/INST]</s>",
         "[/INST]</s>", "line\nbreak", "ends with <", "[", "</s", "INST]", "\\", "<s><s>[INST][INST]", "été 漢 🙂", "<n>", "<\\n>"]


def test_round_trip_of_hard_texts(spark):
    rows = [(c, i, role, t) for c, order in enumerate((TEXTS, TEXTS[::-1]))
            for i, t in enumerate(order) for role in (("user", "assistant", "a\nb", "<n>", "<\\n>", "[INST]", "")[(i + c) % 7],)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(df).orderBy("conv_id").collect()
    for r in out:
        turns = [(x[2], x[3]) for x in sorted(rows) if x[0] == r["conv_id"]]
        assert r["round_trip"] and [(t["role"], t["text"]) for t in r["recovered"]] == turns
        # control strings are in the output only where the template has them
        assert r["formatted"].count("<s>[INST]") == len(turns) == r["formatted"].count("[/INST]</s>")
        assert r["formatted"].count("</s>") == len(turns)


def test_digests_and_defined_cases(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 2, "assistant", None), (1, 3, "assistant", "c</s>"),
            (2, 0, None, "x"), (2, 0, None, "x"), (None, 0, "user", "z"), (3, None, "assistant", "long " * 50000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(df)).collect()}
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1]["n_turns"] == 4 and got[1]["loss_chars"] == 6 and got[1]["loss_sha256"] == h("bc</s>")
    assert got[1]["turns_sha256"] == h("user\na\nassistant\nb\nassistant\n\nassistant\nc</s>\n")
    assert got[2]["n_turns"] == 2 and got[2]["turns_sha256"] == h("\nx\n\nx\n") and got[2]["loss_sha256"] == h("")
    assert got[None]["n_turns"] == 1 and got[3]["loss_chars"] == 250000
    assert all(r["round_trip"] for r in got.values())
    assert chat.digests(chat.format_conversations(df.limit(0))).count() == 0


def test_no_python_in_the_plan(spark):
    plan = catalog.op6_chat_formatting(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
