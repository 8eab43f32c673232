import json

import pytest
from pyspark.sql import functions as F

from weir import cli
from weir.operators import generate as G
from weir.operators import pack, quality, relational
from weir.sources import io
from weir.streaming.prompts import stream_answers


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([("train", 0, "q0", "s0"), ("train", 1, "exception", "s1"), ("train", 2, "content_filter", "s2"), ("test", 0, "q3 ", "s3")], "split string, idx long, question string, system string")


def test_answer_resumes_and_reports(spark, rows, tmp_path):
    ledger = f"file://{tmp_path}/l"
    first = G.answer(rows, G.EchoGenerator, ledger, "question", max_samples=1)
    assert sorted((r.split, r.idx, r.response) for r in first.collect()) == [("test", 0, "q3"), ("train", 0, "q0")]
    out = G.answer(rows, G.EchoGenerator, ledger, "question", chunk=1)
    assert out.columns == sorted(out.columns)
    assert sorted((r.split, r.idx, r.response) for r in out.collect()) == [("test", 0, "q3"), ("train", 0, "q0")]
    failed = G.read_ledger(spark, f"{ledger}/failed", G.ledger_schema("x string")[1])
    assert sorted(r.error for r in failed.collect()) == ["exception", "the answer was filtered"]
    n = G.answer(rows, None, ledger, "question").count()  # nothing is left, so no generator is made
    assert n == 2


def test_answer_guards(rows):
    for bad in ({"user_column": "no"}, {"user_column": "question", "response_column": "system"}, {"user_column": "question", "system_column": "no"}, {"user_column": "question", "system_column": "system", "system_message": "x"}):
        with pytest.raises(ValueError):
            G.answer_jobs(rows, **bad)


def test_translate_and_converse(spark, rows, tmp_path):
    out = G.translate(rows, G.EchoGenerator, f"file://{tmp_path}/t", ["question", "system"], "English", "Dutch", {"question": "to {tgt_lang}", "system": "S"})
    assert set(out.columns) == {"split", "idx", "question", "system", "question_dutch", "system_dutch"}
    assert {r.question_dutch for r in out.collect()} == {"to Dutch"}
    prompt = "user: {subject}\nassistant: {persona}"
    got = G.converse(rows, G.EchoGenerator, f"file://{tmp_path}/c", "question", prompt, personas={"personas": {"a": "A", "b": "B"}, "weights": {"a": 1, "b": 0}})
    assert {(r.persona, r.messages[1].content) for r in got.collect()} == {("a", "A")}
    assert got.count() == 4
    with pytest.raises(ValueError):
        G.translate_jobs(rows, ["question"], None, None, "{src_lang}")
    with pytest.raises(ValueError):
        G.translate_jobs(rows, ["question"], None, None, {"other": "x"})
    with pytest.raises(ValueError):
        G.converse_jobs(rows, "question", "")


def test_generator_contract(tmp_path):
    g = G.EchoGenerator()
    m = [{"role": "user", "content": "stop"}]
    r = g.query_messages((5, m), "x")
    assert (r.job_idx, r.text_response, r.finish_reason, r.extra_args, r.messages) == (5, "stop", "stop", ["x"], m)
    assert [x.job_idx for x in g.batch_query_messages([m, m])] == [0, 1]
    assert [x.job_idx for x in G.EchoGenerator(max_workers=3).batch_query_messages([(4, m), (2, m)], ["a", "b"])] == [4, 2]
    with pytest.raises(ValueError):
        list(g.batch_query_messages([m], ["a", "b"]))
    for bad in ({"timeout": -1}, {"max_retries": -1}):
        with pytest.raises(ValueError):
            G.EchoGenerator(**bad)
    f = tmp_path / "c.json"
    f.write_text(json.dumps({"one": {"azure_endpoint": "e", "azure_deployment": "d1"}, "two": {"api_key": "k"}}))
    assert len(G.load_credentials(str(f))) == 2 and G.ClientGenerator(G.load_credentials(str(f), "one")).is_azure
    with pytest.raises(KeyError):
        G.load_credentials(str(f), "three")
    with pytest.raises(FileNotFoundError):
        G.load_credentials("no.json")
    with pytest.raises(ValueError):
        G.choose_generator()
    assert G.LocalGenerator("x-AWQ", True).quantization == "awq"


def test_retry_stops():
    class Flaky(G.TextGenerator):
        n = 0

        def complete(self, i, m):
            self.n += 1
            if self.n < 3:
                raise RuntimeError("again")
            return "ok", "length"

    assert Flaky(timeout=0).query_messages([]).text_response == "ok"
    assert Flaky(timeout=0, max_retries=2).query_messages([]).error == "again"


def test_dutch_phrases(spark):
    bad = ["Als AI-taalmodel kan ik", "ik ben een taalmodel", "gpt-4 is", "het SPIJT ME", "an assistant", "cutoff in 2023"]
    good = ["Dit is een gewone zin over het weer.", "De assistent van de kapper"]
    df = spark.createDataFrame([(t,) for t in bad + good + ["Привет"]], "text string")
    assert {r.text for r in quality.quality_filter(df, ["text"], target=None).collect()} == set(good)
    lid = quality.identify_language(spark.createDataFrame([("de kat en het huis",), (None,)], "text string"), ["text"]).collect()
    assert [r.text_lid for r in lid] == ["nld_Latn", None]
    assert quality.quality_filter(df, ["text"]).count() == 2


def test_dedup_is_sequential_and_null_safe(spark):
    df = spark.createDataFrame([(0, "a", 1), (1, "a", 2), (2, "b", 1), (3, None, 3), (4, None, 4)], "idx long, x string, y int").repartition(3)
    assert sorted(r.idx for r in relational.dedup_sequential(df, ["x", "y"]).collect()) == [0, 3]


def test_pivot_guard_and_joins(spark):
    long = spark.createDataFrame([("s", 0, "a", "1"), ("s", 0, "a", "2")], "split string, idx long, column string, v string")
    with pytest.raises(Exception, match="two rows"):
        relational.pivot_ledger(long, "v", ["a"]).collect()
    assert relational.pivot_ledger(long.limit(1), "v", ["a", "b"]).first().b == ""
    with pytest.raises(ValueError):
        relational.join_columns(long, long)


def test_merge_suffixes(spark):
    f = lambda v: spark.createDataFrame([(0, "k", v), (1, None, v)], "idx long, k string, v string")
    got = relational.merge_revisions([f("a"), f("b"), f("c").withColumnRenamed("v", "w")], ["k"])
    assert sorted(got.columns) == ["k", "v_x", "v_y", "w"] and got.count() == 2
    with pytest.raises(ValueError):
        relational.merge_revisions([f("a"), f("b"), f("c"), f("d")], ["k"])


def test_mix_guards(spark):
    df = spark.range(10).withColumnRenamed("id", "idx")
    assert relational.prefix_fraction(df, 0.29).count() == 2
    with pytest.raises(ValueError):
        relational.prefix_fraction(df, -0.1)
    with pytest.raises(IndexError):
        relational.prefix_fraction(df, 1.1)
    with pytest.raises(ValueError):
        relational.split_kind("dev")
    assert relational.mix([("a", "train", df, 0.5), ("b", "test_x", df, 1.0)])["train"].count() == 5


def test_blocks_do_not_depend_on_partitions(spark):
    df = spark.range(40).select(F.col("id").alias("idx"), F.transform(F.sequence(F.lit(0), F.col("id") % 7), lambda x: (x + F.col("id")).cast("int")).alias("input_ids"))
    want, lists = [], [[int(i + j) for j in range(i % 7 + 1)] for i in range(40)]
    for b in range(0, 40, 15):
        flat = sum(lists[b : b + 15], [])
        want += [(b // 15, k, flat[8 * k : 8 * k + 8]) for k in range(len(flat) // 8)]
    for pack_ in (pack.pack_blocks, pack.pack_blocks_fast):
        for parts in (1, 5):
            got = sorted((r.batch, r.block_no, list(r.input_ids)) for r in pack_(df.repartition(parts), 8, 15).collect())
            assert got == want
    assert pack.pack_blocks(df, 10_000).count() == 0


def test_ranked(spark):
    df = spark.range(1000).withColumnRenamed("id", "k").repartition(7)
    assert all(r.k == r.idx for r in relational.ranked(df, ["k"]).collect())


def test_datasets(spark, rows, tmp_path):
    path = f"file://{tmp_path}/d"
    io.write_dataset(rows, path)
    assert io.read_dataset(spark, path, "train").count() == 3
    with pytest.raises(ValueError):
        io.read_dataset(spark, path, "dev")
    assert io.read_split(spark, path, "test").count() == 1
    io.publish_to(f"file://{tmp_path}/hub", "name", "v1")(path)
    assert list(io.read_revisions(spark, f"file://{tmp_path}/hub/name")) == ["v1"]
    rows.where("split = 'test'").drop("split").write.parquet(f"file://{tmp_path}/e/test")
    assert io.read_dataset(spark, f"file://{tmp_path}/e", order=["question"]).first().idx == 0
    (tmp_path / "r.jsonl").write_text('{"model":"o/m","task":"t","dataset":"d","results":{"total":{"test_f1":1.0}}}\n\n')
    assert relational.flatten_scores(io.read_records(spark, f"file://{tmp_path}/r.jsonl")).first().model == "m"
    assert len(io.write_sheets(rows, "split", f"{tmp_path}/x")) == 2


def test_tsv_ledger(spark, tmp_path):
    (tmp_path / "t.tsv").write_text('split\tcolumn\tidx\tresponse\ntrain\tc\t1\t"a\nb"\n')
    schema = G.ledger_schema("response string")[0]
    G.migrate_tsv(spark, f"file://{tmp_path}/t.tsv", f"file://{tmp_path}/j", schema)
    assert G.read_ledger(spark, f"file://{tmp_path}/j", schema).first().response == "a\nb"


def test_stream(spark, rows, tmp_path):
    rows.write.parquet(f"{tmp_path}/in")
    prepare = lambda df: df.select("split", "idx", F.col("idx").alias("job_idx"), F.array(F.struct(F.lit("user").alias("role"), F.col("question").alias("content"))).alias("messages"))
    q = stream_answers(spark, f"{tmp_path}/in", "split string, idx long, question string, system string", prepare, G.EchoGenerator, f"{tmp_path}/out", f"{tmp_path}/cp")
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").where("error is null").count() == 2


def test_cli(spark, rows, tmp_path):
    io.write_dataset(rows, f"file://{tmp_path}/d")
    cli.main(["answer", "--dataset", f"file://{tmp_path}/d", "--output", f"file://{tmp_path}/o", "--ledger", f"file://{tmp_path}/l", "--echo", "--user-column", "question"], spark)
    assert spark.read.parquet(f"{tmp_path}/o").count() == 2
    cli.main(["clm", "--dataset", f"file://{tmp_path}/d", "--output", f"file://{tmp_path}/b", "--split", "train", "--text-column", "question", "--block-size", "2"], spark)
    assert spark.read.parquet(f"{tmp_path}/b").count() == 1
    said, lines = [], iter(["hi", "restart", "yo", "exit"])
    cli.repl(G.EchoGenerator(), None, lambda _: next(lines), said.append)
    assert said == ["hi", "yo"]


def test_ranked_keeps_every_row(spark):
    """Wide rows over many partitions that adaptive execution coalesces."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        df = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("h"), F.repeat(F.lit("x"), 200).alias("wide"), F.pmod("id", F.lit(7)).alias("g")).repartition(9)
        got = [tuple(r) for r in relational.ranked(df, ["g", "h"]).select("idx", "g", "h").orderBy("idx").collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [r[0] for r in got] == list(range(20_000))
    assert [r[1:] for r in got] == sorted(r[1:] for r in got)


def test_prefixes_do_not_need_gapless_idx(spark):
    df = spark.range(100).withColumnRenamed("id", "idx").where("idx % 3 = 0")
    assert sorted(r.idx for r in relational.first_n(df, 4).collect()) == [0, 3, 6, 9]
    assert sorted(r.idx for r in relational.prefix_fraction(df, 0.2).collect()) == [0, 3, 6, 9, 12, 15]
    assert relational.prefix_fraction(df.limit(0), 0.5).count() == 0


def test_small_reports(spark):
    df = spark.range(9).withColumnRenamed("id", "idx")
    assert [r.idx for r in relational.preview(df)] == [0, 1, 2]
    got = spark.sql("select map('b', 1, 'a', 2) m").select(relational.sorted_items(F.col("m")).alias("x")).first().x
    assert [tuple(r) for r in got] == [("a", 2), ("b", 1)]
    assert io.pair_configs(["a", "b"], None, [0.5, 1.0]) == [("a", None, 0.5), ("b", None, 1.0)]
    with pytest.raises(ValueError):
        io.pair_configs(["a", "b"], ["x"])


def test_batches_of_a_local_model_and_completion_order(spark):
    class Fake(G.LocalGenerator):
        calls = []

        def complete_many(self, batch):
            self.calls.append(len(batch))
            if any(m[0]["content"] == "bad" for m in batch):
                raise RuntimeError("bad")
            return [(m[0]["content"].upper(), "stop") for m in batch]

    jobs = [[{"role": "user", "content": c}] for c in ("a", "b", "c", "bad", "e")]
    got = list(Fake("m", batch_size=2).batch_query_messages(jobs, list(range(5))))
    assert [g.text_response for g in got] == ["A", "B", "C", None, "E"] and [g.extra_args for g in got] == [[i] for i in range(5)]
    assert Fake.calls[0] == 2 and got[3].error == "bad"
    slow = G.EchoGenerator(max_workers=3, in_order=False)
    assert sorted(r.job_idx for r in slow.batch_query_messages(jobs)) == list(range(5))


def test_packing_takes_every_list(spark):
    import random

    rnd = random.Random(4)
    rows = []
    for i in range(120):
        ids = [rnd.randrange(100) for _ in range(rnd.choice([0, 1, 5, 40]))]
        rows.append((i * 3, ids if i % 17 else None, [x % 2 for x in ids] if i % 17 else None, [f"w{x}" for x in ids] if i % 17 else None, "other"))
    df = spark.createDataFrame(rows, "idx long, input_ids array<int>, attention_mask array<int>, words array<string>, note string").repartition(5)
    want = []
    for b in range(0, 360, 60):
        part = [r for r in rows if b <= r[0] < b + 60]
        cat = [[x for r in part for x in (r[k] or [])] for k in (1, 2, 3)]
        want += [(b // 60, j, *[c[j * 16 : j * 16 + 16] for c in cat], cat[0][j * 16 : j * 16 + 16]) for j in range(len(cat[0]) // 16)]
    names = ["batch", "block_no", "input_ids", "attention_mask", "words", "labels"]
    for f in (pack.pack_blocks, pack.pack_blocks_fast):
        assert sorted(tuple(r[n] for n in names) for r in f(df, 16, 60).collect()) == want
    bad = df.withColumn("words", F.slice("words", 1, 3))
    for f in (pack.pack_blocks, pack.pack_blocks_fast):
        with pytest.raises(Exception, match="differ"):
            f(bad, 16, 60).collect()
    with pytest.raises(ValueError):
        pack.pack_blocks(df.select("idx", "note"), 4)


def test_windows_of_tokens(spark):
    df = spark.createDataFrame([(0, "a bb ccc"), (1, ""), (2, None), (3, "dddd")], "idx long, text string")
    count = lambda: lambda t: [len(w) for w in t.split()]
    ids = lambda **how: [r.input_ids for r in pack.tokenize(df, factory=count, **how).orderBy("idx").collect()]
    assert ids() == [[1, 2, 3], [], [], [4]] and ids(max_length=2) == [[1, 2], [], [], [4]] and ids(max_length=2, side="left") == [[2, 3], [], [], [4]]
    assert pack.tokenize(df, factory=count, max_length=2, mask=True).orderBy("idx").first().attention_mask == [1, 1]
    for bad in ({"max_length": 0}, {"max_length": 1, "side": "up"}):
        with pytest.raises(ValueError):
            ids(**bad)


def test_chat_blocks_by_a_program_with_left_truncation(spark):
    from weir.functions import messages as M
    from weir.functions.template import ProgramTemplate

    talk = [("user", "a b c d"), ("assistant", "e f")]
    df = spark.createDataFrame([(i, talk, talk[:1] + [("assistant", "g h")]) for i in range(4)], f"idx long, chosen {M.DDL}, rejected {M.DDL}")
    words = lambda: lambda t: [ord(w[-1]) for w in t.split()]
    program = ProgramTemplate("{% for m in messages %}{{ m.content }} {% endfor %}")
    for task in ("rm", "dpo", "orpo"):
        got = pack.prepare_chat([("d", "train", df, 1.0)], 2, task, words, template=program, max_length=2, mask=True)["train"].collect()
        assert [r.input_ids for r in got] == [[ord("e"), ord("f")]] * 4 and got[0].attention_mask == [1, 1]


def test_first_rows_of_each_split(spark):
    rows = [("train", i * 7) for i in range(50)] + [("test", i * 5 + 1) for i in range(30)] + [(None, 3), (None, 1)]
    df = spark.createDataFrame(rows, "split string, idx long").repartition(6)
    for n in (0, 1, 20, 40, 1000):
        want = sorted(r for s in ("train", "test", None) for r in [x for x in rows if x[0] == s][:n] if s is not None) + [(None, 1), (None, 3)][:n]
        for small in (1000, 0):
            got = [tuple(r) for r in relational.first_n(df, n, small).collect()]
            assert sorted((r for r in got if r[0] is not None)) + sorted((r for r in got if r[0] is None), key=lambda r: r[1]) == want
    assert sorted(r.idx for r in relational.first_n(df.where("split = 'train' and idx > 0").drop("split"), 3).collect()) == [7, 14, 21]
    with pytest.raises(ValueError):
        relational.first_n(df, -1)


def test_max_samples_after_a_filter(spark, tmp_path):
    df = spark.createDataFrame([("train", i, f"q{i}") for i in range(0, 60, 3)] + [("test", i, f"t{i}") for i in range(2, 60, 9)], "split string, idx long, question string")
    got = G.answer(df, G.EchoGenerator, f"file://{tmp_path}/l", "question", max_samples=4)
    assert sorted(r.response for r in got.collect()) == sorted(["q0", "q3", "q6", "q9", "t2", "t11", "t20", "t29"])


class Watched(G.TextGenerator):
    """Notes when each call begins and ends."""

    def __init__(self, folder, workers):
        super().__init__(max_workers=workers, max_retries=1, in_order=False)
        self.folder = folder

    def complete(self, job_idx, messages):
        import time
        import uuid

        begin = time.time()
        time.sleep(0.05 + 0.01 * (job_idx % 3))
        with open(f"{self.folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(f"{begin} {time.time()}")
        return f"answer {messages[0]['content']}", "stop"


@pytest.mark.parametrize("most,workers", [(4, 2), (3, 2), (1, 3), (2, 5)])
def test_calls_of_a_whole_job_are_bounded(spark, tmp_path, most, workers):
    """Answers come as they are ready and still belong to their rows."""
    df = spark.range(24).select(F.lit("train").alias("split"), F.col("id").alias("idx"), F.concat(F.lit("q"), "id").alias("question")).repartition(8)
    folder = tmp_path / "calls"
    folder.mkdir()
    out = G.answer(df, lambda: Watched(str(folder), workers), f"file://{tmp_path}/l", "question", most_calls=most).collect()
    assert {r.idx: r.response for r in out} == {i: f"answer q{i}" for i in range(24)}
    spans = [tuple(map(float, f.read_text().split())) for f in folder.iterdir()]
    assert len(spans) == 24 and max(sum(a <= t < b for a, b in spans) for t, _ in spans) <= most
    with pytest.raises(ValueError):
        G.respond(df, G.EchoGenerator, 0)


def test_a_ledger_keeps_the_first_row_of_a_cell(spark, tmp_path):
    import os

    for k, text in enumerate(("late", "first", "later")):
        folder = tmp_path / "l" / "done"
        folder.mkdir(parents=True, exist_ok=True)
        f = folder / f"{'cab'[k]}.json"
        f.write_text(json.dumps({"split": "train", "column": "response", "idx": 1, "response": text}) + "\n")
        os.utime(f, (1000 + [50, 0, 90][k],) * 2)
    schema = G.ledger_schema("response string")[0]
    assert [r.response for r in G.read_ledger(spark, f"file://{tmp_path}/l/done", schema).collect()] == ["first"]
    df = spark.createDataFrame([("train", 1, "q"), ("train", 2, "r")], "split string, idx long, question string")
    got = G.answer(df, None, f"file://{tmp_path}/l", "question", only_save_current=True)
    assert [(r.idx, r.response) for r in got.collect()] == [(1, "first")]


def test_cli_options(spark, tmp_path):
    from weir.functions import messages as M

    words = {"train": ["de kat en het huis op een berg", "het spijt me van de kat", "the cat and the dog are in it"], "test": ["nog een zin van de kat die niet kan"]}
    text = spark.createDataFrame([(s, i, t, t.split()[0]) for s, ts in words.items() for i, t in enumerate(ts)], "split string, idx long, text string, label string")
    d = f"file://{tmp_path}/d"
    io.write_dataset(text, d)
    cli.main(["filter", "--dataset", d, "--output", f"file://{tmp_path}/f", "--column", "text"], spark)
    assert spark.read.parquet(f"{tmp_path}/f").count() == 2
    cli.main(["fit-lid", "--dataset", d, "--output", f"{tmp_path}/m.json", "--label-column", "label"], spark)
    cli.main(["lid", "--dataset", d, "--output", f"file://{tmp_path}/i", "--column", "text", "--model", f"{tmp_path}/m.json"], spark)
    assert {r.label: r.text_lid for r in spark.read.parquet(f"{tmp_path}/i").collect()} == {x: x for x in ("de", "het", "the", "nog")}
    cli.main(["publish", "--dataset", d, "--output", f"file://{tmp_path}/hub", "--name", "n", "--revision", "r1"], spark)
    assert io.read_revisions(spark, f"file://{tmp_path}/hub/n")["r1"].count() == 4
    cli.main(["snapshot", "--dataset", f"file://{tmp_path}/d", "--output", f"{tmp_path}/s.txt", "--allow", "*.parquet", "--ignore", "split=test*"], spark)
    assert all("split=train" in x for x in (tmp_path / "s.txt").read_text().split())
    args = ["answer", "--dataset", d, "--output", f"file://{tmp_path}/a", "--ledger", f"file://{tmp_path}/l", "--echo", "--user-column", "text"]
    cli.main([*args, "--max-calls", "2", "--max-samples", "1"], spark)
    assert spark.read.parquet(f"{tmp_path}/a").count() == 2
    args[args.index("--output") + 1] = f"file://{tmp_path}/b"
    cli.main([*args, "--only-save-current"], spark)
    assert spark.read.parquet(f"{tmp_path}/b").count() == 2
    talks = [[("user", "a b c"), ("assistant", "d e")], [("user", "f"), ("assistant", "g")]]
    for k in (0, 1):
        c = spark.createDataFrame([("train", i, talks[k]) for i in range(4)] + [("test", 9, talks[k])], f"split string, idx long, messages {M.DDL}")
        io.write_dataset(c, f"file://{tmp_path}/c{k}" + "/conf" * k)
    (tmp_path / "t.jinja").write_text("{% for m in messages %}{{ m.content }} {% endfor %}")
    chat = ["chat", "--dataset", f"file://{tmp_path}/c0", "--more", f"file://{tmp_path}/c1", "--config", "-", "--config", "conf", "--fraction", "0.5", "--fraction", "1"]
    cli.main([*chat, "--output", f"{tmp_path}/p", "--block-size", "2", "--template", f"{tmp_path}/t.jinja", "--max-length", "2"], spark)
    assert spark.read.parquet(f"{tmp_path}/p/train").count() == 6 and spark.read.parquet(f"{tmp_path}/p/test").count() == 2
    (tmp_path / "r.jsonl").write_text("\n".join(json.dumps({"model": "o/checkpoint-7", "task": "t", "dataset": x, "results": {"total": {m: 0.5}}}) for x, m in relational.METRICS.items()))
    cli.main(["scores", "--dataset", f"file://{tmp_path}/r.jsonl", "--output", f"{tmp_path}/o.csv", "--workbook", f"{tmp_path}/o.xlsx", "--plots", f"{tmp_path}/plots"], spark)
    assert len(list((tmp_path / "plots").iterdir())) == len(relational.METRICS)
    assert (tmp_path / "o.csv").read_text().startswith("model,") and (tmp_path / "o.xlsx").stat().st_size > 500


def test_tokenize_holds_the_numbers_of_a_bounded_part(spark):
    import pyarrow as pa

    texts = ["a b", None, "x" * 300, "", "c " * 200, "d"]
    got = list(pack.slices(iter([pa.array(texts), pa.array([], pa.string())]), 256))
    assert sum((p.to_pylist() for p in got), []) == texts and len(got) > 3
    assert all(len(p) < 2 or sum(len(t or "") for t in p.to_pylist()) <= 512 for p in got)
    t = pack.hash_tokenizer()
    many = ["".join(f"w{i * j} " for j in range(1, 400)) for i in range(1, 2_500)] + ["", None]
    df = spark.createDataFrame(list(enumerate(many)), "idx long, text string").coalesce(1)
    assert all(r.input_ids == t(many[r.idx] or "") for r in pack.tokenize(df).collect())
    held = pack.tokenize(df, factory=lambda: lambda x: [len(x)] * 3).agg({"idx": "count"}).first()[0]
    assert held == len(many)
