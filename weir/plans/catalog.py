"""The registered queries over the driver's tables and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.functions import messages as M
from weir.functions import text as X
from weir.functions.template import ProgramTemplate
from weir.operators import generate, language, pack, quality, relational
from weir.sources.shared import fresh_path

# ---- inputs as datasets: a split and an idx column ----


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet").withColumn("idx", F.col("doc_id")).withColumn("split", F.lit("train"))


def _turns(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/conversations.parquet")


def _convs(spark: SparkSession, d: str) -> DataFrame:
    """One row per conversation with its turns as messages."""
    m = F.transform(F.sort_array(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))), lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    return _turns(spark, d).groupBy("conv_id").agg(m.alias("messages")).withColumn("split", F.lit("train")).withColumn("idx", F.col("conv_id"))


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    """Preference rows: the conversation, and the same with other letters in the last turn."""
    c = _convs(spark, d)
    last = F.element_at("messages", -1)
    worse = F.concat(F.slice("messages", F.lit(1), F.size("messages") - 1), F.array(F.struct(last["role"].alias("role"), F.replace(last["content"], F.lit("e"), F.lit("_")).alias("content"))))
    return c.select("conv_id", F.col("messages").alias("chosen"), worse.alias("rejected"))


LANG = {"en": "eng_Latn", "de": "deu_Latn", "fr": "fra_Latn", "es": "spa_Latn"}


def _lid():
    return F.element_at(F.create_map(*[F.lit(x) for kv in LANG.items() for x in kv]), F.col("lang"))


WORDS = ["the", "OpenAI", "sorry", "was"]
PROMPT = "Talk about {subject} as {persona}. Begin turns with user: or assistant: only."
PERSONAS = {"personas": {"teacher": "a teacher", "nurse": "a nurse", "pilot": "a pilot"}, "weights": {"teacher": 5, "nurse": 3, "pilot": 2}}


def _ledger_like(spark: SparkSession, d: str) -> DataFrame:
    """Ledger rows made of documents: two columns, and no system cell where the language is not English."""
    x = _docs(spark, d).select("split", "idx", F.col("text").alias("question"), F.when(F.col("lang") == "en", F.col("source")).alias("system"))
    long = relational.unpivot(x, ["split", "idx"], ["question", "system"])
    return long.where(F.col("text").isNotNull()).withColumnRenamed("text", "response")


def _errors(spark: SparkSession, d: str) -> DataFrame:
    k = F.pmod("event_id", F.lit(7))
    text = F.when(k == 0, "Error code: 429 - slow down, timed out").when(k == 1, "Empty conversation").when(k == 2, "Request Timed Out").when(k == 3, "a time out").when(k == 4, "TIMEOUT").otherwise("other")
    return spark.read.parquet(f"{d}/events.parquet").select(F.col("event_id").alias("idx"), text.alias("error"))


def _scores(spark: SparkSession, d: str) -> DataFrame:
    """Score records made of orders: a model per customer bucket, a dataset per priority."""
    o = spark.read.parquet(f"{d}/orders.parquet")
    names = F.array(*[F.lit(x) for x in relational.METRICS])
    data = F.element_at(names, (F.pmod(F.floor(F.col("o_orderkey") / 8), F.lit(7)) + 1).cast("int"))
    metric = F.element_at(F.create_map(*[F.lit(x) for kv in relational.METRICS.items() for x in kv]), data)
    total = F.create_map(metric, (F.pmod("o_custkey", F.lit(1000)) / 1000), F.concat(metric, F.lit("_se")), F.lit(0.5))
    model = F.concat(F.lit("org/ckpt-"), F.pmod("o_custkey", F.lit(40)).cast("string"))
    return o.select(F.col("o_orderkey").alias("idx"), model.alias("model"), F.lit("t").alias("task"), data.alias("dataset"), F.struct(total.alias("total")).alias("results"))


# ---- queries ----


def curate_documents(spark, d):
    """Flagship: normalise, first row of each text, language rule with its exception for short texts, word count."""
    x = _docs(spark, d).select("split", "idx", "doc_id", X.normalize_ws(F.col("text")).alias("text"), _lid().alias("text_lid"))
    x = relational.dedup_sequential(x, ["text"])
    x = quality.quality_filter(x, ["text"], target="eng_Latn", normal=True)
    return x.select("doc_id", F.md5("text").alias("text_md5"), X.word_count(F.col("text")).cast("long").alias("n_tokens"))


def normalize_ws(spark, d):
    return _docs(spark, d).select("doc_id", X.normalize_ws(F.col("text")).alias("norm"))


def strip_lines(spark, d):
    one = _docs(spark, d).select("doc_id", F.explode(X.split_lines(F.col("text"))).alias("line"))
    return one.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum(F.length(X.strip(F.col("line")))).cast("long").alias("n_stripped"))


def token_count(spark, d):
    return _docs(spark, d).select("doc_id", X.token_count(F.col("text")).cast("long").alias("n_tokens"))


def dedup_text(spark, d):
    return relational.dedup_sequential(_docs(spark, d).select("idx", "text"), ["text"]).select(F.col("idx").alias("doc_id"))


def dedup_sequential(spark, d):
    x = _docs(spark, d).select("idx", "text", "source", "n_chars")
    return relational.dedup_sequential(x, ["text", "n_chars"]).select(F.col("idx").alias("doc_id"), "source")


def dedup_conversation(spark, d):
    return relational.dedup_sequential(_convs(spark, d), ["messages"]).select("conv_id")


def phrase_filter(spark, d):
    pattern = quality.phrase_pattern(["loser"], [WORDS], ["als (?:een )?{}", "{} ben"])
    return quality.quality_filter(_docs(spark, d).select("doc_id", "text"), ["text"], target=None, pattern=pattern, roman=False).select("doc_id")


PLANTED = ["Als een taalmodel denk ik", "vraag het aan ChatGPT", "mijn kennisstop in 2023", "IT SEEMS LIKE THERE WAS A TYPO", "het \u017fpijt me", "de assistent van de kapper"]


def planted_phrases(spark, d):
    """The real phrase lists, on texts to which sentences of each kind were added; the last is harmless."""
    planted = F.element_at(F.array(*[F.lit(p) for p in PLANTED]), (F.pmod("doc_id", F.lit(len(PLANTED) + 2)) + 1).cast("int"))
    x = _docs(spark, d).withColumn("text", F.when(F.pmod("doc_id", F.lit(len(PLANTED) + 2)) < len(PLANTED), F.concat("text", F.lit("\n"), planted)).otherwise(F.col("text")))
    return quality.quality_filter(x, ["text"], target=None).select("doc_id")


#: One letter of scripts old and new (Greek, Chinese, Arabic extended, Toto, Kawi, the latest Chinese extension), then Roman ones and a mark.
LETTERS = ["\u03b1", "\u4e2d", "\u0870", "\U0001e290", "\U00011f04", "\U0002ebf0", "\u1e9e", "\U0001df25", "\u0301"]


def roman_filter(spark, d):
    letter = F.element_at(F.array(*[F.lit(x) for x in LETTERS]), (F.pmod("doc_id", F.lit(20)) + 1).cast("int"))
    x = _docs(spark, d).withColumn("text", F.when(F.pmod("doc_id", F.lit(20)) < len(LETTERS), F.concat("text", F.lit(" "), letter)).otherwise(F.col("text")))
    return x.where(X.is_roman(F.col("text"))).select("doc_id")


def lid_filter(spark, d):
    x = _docs(spark, d).withColumn("text", F.when(F.pmod("doc_id", F.lit(4)) == 0, "a short  one").otherwise(F.col("text")))
    return x.where(quality.language_ok(F.col("text"), _lid(), "deu_Latn")).select("doc_id", "lang")


def identify_language(spark, d):
    """A model of the labelled rows, four in five for fitting, scores all texts."""
    x = _docs(spark, d).select("doc_id", "text", "lang")
    model = language.fit_language_model(x.where(F.pmod("doc_id", F.lit(5)) != 0))
    x = quality.identify_language(x, ["text"], model)
    return x.select("doc_id", "text_lid", F.round("text_lid_prob", 6).alias("text_lid_prob"))


def glue(spark, d):
    return _convs(spark, d).select("conv_id", M.glue(F.col("messages")).alias("text"))


def assistant_text(spark, d):
    return _convs(spark, d).select("conv_id", M.assistant_text(F.col("messages")).alias("text"))


def insert_system(spark, d):
    m = M.insert_system(F.col("messages"), "system")
    return _convs(spark, d).select("conv_id", F.size(m).cast("long").alias("n"), F.get(m, 0)["role"].alias("first_role"), F.get(m, 0)["content"].alias("first_content"))


def render_sft(spark, d):
    return M.render_chat(_convs(spark, d), "sft").select("conv_id", "text")


def render_generation(spark, d):
    return M.render_chat(_convs(spark, d), "generation", auto_system=False).select("conv_id", "text")


def render_rm(spark, d):
    return M.render_chat(_pairs(spark, d), "rm").select("conv_id", "text_chosen", "text_rejected")


def render_dpo(spark, d):
    return M.render_chat(_pairs(spark, d), "dpo", auto_system=False).select("conv_id", "text_prompt", "text_chosen", "text_rejected")


ROLES_PROGRAM = """{% for message in messages %}
{% if message['role'] in ['system', 'user', 'assistant'] %}
{{ '<|' + message['role'] + '|>\n' + message['content'] + eos_token }}
{% endif %}
{% if loop.last and add_generation_prompt %}
{{ '<|assistant|>' }}
{% endif %}
{% endfor %}"""
CHATML_PROGRAM = """{%- for message in messages -%}
    {%- if loop.first and messages[0]['role'] != 'system' -%}
        {{ '<|im_start|>system\nBe brief.<|im_end|>\n' }}
    {%- endif -%}
    {{ '<|im_start|>' ~ message.role ~ '\n' ~ message.content ~ '<|im_end|>\n' }}
{%- endfor -%}
{%- if add_generation_prompt -%} {{- '<|im_start|>assistant\n' -}} {%- endif -%}"""
INST_PROGRAM = """{% if messages[0]['role'] == 'system' %}
{% set system = messages[0]['content'] | trim %}{% set turns = messages[1:] %}
{% else %}
{% set system = false %}{% set turns = messages %}
{% endif %}
{% for turn in turns %}
{% if (turn['role'] == 'user') != (loop.index0 % 2 == 0) %}{{ raise_exception('user and assistant must alternate') }}{% endif %}
{% set content = '<<SYS>>\n' + system + '\n<</SYS>>\n\n' + turn.content if loop.first and system != false else turn.content %}
{% if turn.role == 'user' %}
{{- bos_token + '[INST] ' + content.strip() + ' [/INST]' -}}
{% else %}
{{- ' ' ~ turn.content | trim ~ ' ' ~ eos_token -}}
{% endif %}
{% endfor %}"""


def render_roles_program(spark, d):
    """A template program of the kind that tokenizers carry, in place of the table of roles; one line end follows what is printed last."""
    return M.render_chat(_convs(spark, d), "generation", ProgramTemplate(ROLES_PROGRAM)).select("conv_id", "text")


def render_chatml_program(spark, d):
    return M.render_chat(_convs(spark, d), "generation", ProgramTemplate(CHATML_PROGRAM), auto_system=False).select("conv_id", "text")


def render_inst_program(spark, d):
    return M.render_chat(_convs(spark, d), "sft", ProgramTemplate(INST_PROGRAM), auto_system=False).select("conv_id", "text")


def render_orpo_program(spark, d):
    """Preference rows by a program: prompt, and the last turn of either side."""
    return M.render_chat(_pairs(spark, d), "orpo", ProgramTemplate(CHATML_PROGRAM), auto_system=False).select("conv_id", "text_prompt", "text_chosen", "text_rejected")


def parse_conversation(spark, d):
    lines = F.concat_ws("\n", F.transform(F.filter("messages", lambda x: x["role"] != "system"), lambda x: F.concat(x["role"], F.lit(": "), x["content"])))
    m = M.parse_conversation(lines, "user:", "assistant:")
    x = _convs(spark, d).select("conv_id", F.posexplode(m).alias("pos", "m"))
    return x.select("conv_id", F.col("pos").cast("long").alias("pos"), F.col("m.role").alias("role"), F.col("m.content").alias("content"))


def _flat(m):
    return F.array_join(F.transform(m, lambda x: F.concat(x["role"], F.lit("="), x["content"])), "|")


def answer_prompts(spark, d):
    j = generate.answer_jobs(_docs(spark, d).select("split", "idx", "text", "source"), "text", "source")
    return j.select("idx", "column", _flat(F.col("messages")).alias("prompt"))


def translate_prompts(spark, d):
    j = generate.translate_jobs(_docs(spark, d).select("split", "idx", "text", "source"), ["text", "source"], "English", "Dutch", "From {src_lang} to {tgt_lang}")
    return j.select("idx", "column", _flat(F.col("messages")).alias("prompt"))


def converse_prompts(spark, d):
    j = generate.converse_jobs(_docs(spark, d).select("split", "idx", "source"), "source", PROMPT, "user:", "assistant:", PERSONAS)
    return j.select("idx", "persona", _flat(F.col("messages")).alias("prompt"))


def persona_bucket(spark, d):
    p = relational.weighted_choice(["a", "b", "c"], [5, 3, 2], 7, F.col("doc_id"))
    return _docs(spark, d).groupBy(p.alias("persona")).agg(F.count("*").alias("n"))


def answer_echo(spark, d):
    """The whole answer processor with the echo generator, ledgers and all."""
    x = _docs(spark, d).select("split", "idx", F.col("text").alias("question"))
    out = generate.answer(x, generate.EchoGenerator, fresh_path(spark, "answer"), "question", chunk=1_000_000)
    return out.select("idx", "question", "response")


class Exclaimer(generate.TextGenerator):
    """Answers with the last message and a mark; answers come as they are ready."""

    def __init__(self):
        super().__init__(max_workers=3, max_retries=1, in_order=False)

    def complete(self, job_idx, messages):
        return messages[-1]["content"] + " !", "stop"


def translate_marks(spark, d):
    """The whole translate processor over two columns; blank texts are skipped and come back empty."""
    x = _docs(spark, d).select("split", "idx", F.when(F.pmod("idx", F.lit(6)) != 0, F.col("text")).otherwise(" \n").alias("text"), F.coalesce("source", F.lit("none")).alias("source"))
    out = generate.translate(x, Exclaimer, fresh_path(spark, "translate"), ["text", "source"], "English", "Dutch", chunk=1_000_000, most_calls=6)
    return out.select("idx", "text_dutch", "source_dutch")


TALK = "user: Talk about {subject}.\nassistant: I, {persona}, will.\n\nuser: and"


def converse_echo(spark, d):
    """The whole converse processor: prompts with personas, answers parsed into turns, the last user turn dropped."""
    x = _docs(spark, d).select("split", "idx", F.coalesce("source", F.lit("none")).alias("source"))
    out = generate.converse(x, generate.EchoGenerator, fresh_path(spark, "converse"), "source", TALK, "user:", "assistant:", PERSONAS, chunk=1_000_000)
    return out.select("idx", "persona", _flat(F.col("messages")).alias("turns"))


def answer_first_n(spark, d):
    """The first 70 rows of each of two splits answered, and the rest left out."""
    x = _docs(spark, d).select(F.when(F.col("lang") == "en", "train").otherwise("test").alias("split"), "idx", F.col("lang").alias("question"))
    out = generate.answer(x, Exclaimer, fresh_path(spark, "first"), "question", max_samples=70, chunk=50)
    return out.select("split", "idx", "response")


def resume_antijoin(spark, d):
    done = _docs(spark, d).where(F.pmod("idx", F.lit(3)) == 0)
    return relational.exclude(_docs(spark, d).select("split", "idx", "source"), done).select("idx", "source")


def ledger_union(spark, d):
    a = _docs(spark, d).select("split", F.lit("c").alias("column"), "idx").where(F.pmod("idx", F.lit(2)) == 0)
    b = _docs(spark, d).select("split", F.lit("c").alias("column"), "idx").where(F.pmod("idx", F.lit(3)) == 0)
    return relational.processed(a, b).groupBy("split", "column").agg(F.count("*").alias("n"), F.sum("idx").alias("sum_idx"))


def ledger_pivot(spark, d):
    return relational.pivot_ledger(_ledger_like(spark, d), "response", ["question", "system"]).select("idx", "question", "system")


def merge_original(spark, d):
    x = _docs(spark, d).select("split", "idx", "lang")
    return relational.join_columns(x, relational.pivot_ledger(_ledger_like(spark, d), "response", ["question", "system"])).drop("split")


def failure_report(spark, d):
    return relational.failure_report(_errors(spark, d))


def merge_revisions(spark, d):
    x = _docs(spark, d)
    k = F.when(F.length("text") >= 100, F.md5("text")).alias("k")  # copies share it; short texts share the null key
    a = x.select("idx", k, "lang", F.col("n_chars").alias("n"))
    b = x.select("idx", k, "source", F.when(F.col("lang") != "fr", F.col("n_chars")).alias("n"))
    return relational.merge_revisions([a, b], ["k"])


def mix(spark, d):
    x = _docs(spark, d).select("idx", "source")
    n = spark.read.parquet(f"{d}/pages.parquet").select(F.col("page_id").alias("idx"), F.col("url").alias("source"))
    b = spark.read.parquet(f"{d}/benchmark.parquet").select(F.col("item_id").alias("idx"), F.col("text").alias("source"))
    got = relational.mix([("docs", "train_sft", x, 0.29), ("pages", "train", n, 0.5), ("benchmark", "test", b, 1.0)], seed=None)
    return got["train"].withColumn("kind", F.lit("train")).unionByName(got["test"].withColumn("kind", F.lit("test")))


def shuffle_md5(spark, d):
    o = spark.read.parquet(f"{d}/events.parquet").select("event_id", F.md5(F.concat(F.lit("42-"), F.col("event_id").cast("string"))).alias("h"))
    return relational.ranked(o, ["h", "event_id"]).select("event_id", "idx")


def first_n(spark, d):
    """The first 100 rows of each of two splits, whose idx has gaps."""
    x = _docs(spark, d).withColumn("split", F.when(F.col("lang") == "en", "train").otherwise("test"))
    return relational.first_n(x, 100).select("split", "idx", "lang", "source")


def first_n_many(spark, d):
    """More rows of each split than a window cuts short."""
    x = spark.read.parquet(f"{d}/events.parquet").select(F.when(F.pmod("event_id", F.lit(3)) == 0, "a").otherwise("b").alias("split"), (F.col("event_id") * 3).alias("idx"))
    return relational.first_n(x, 2_000)


def select_sorted(spark, d):
    return relational.sort_columns(_docs(spark, d).select("source", "doc_id", "lang"))


def unpivot_columns(spark, d):
    return relational.unpivot(_docs(spark, d).select("idx", "lang", "source"), ["idx"], ["lang", "source"])


def tokenize(spark, d):
    t = pack.tokenize(_docs(spark, d).select("idx", "text"))
    return t.select("idx", F.size("input_ids").cast("long").alias("n"))


def tokenize_left(spark, d):
    """Long texts keep their last 50 tokens, with a mask as long."""
    t = pack.tokenize(_docs(spark, d).select("idx", "text"), factory=_lengths, max_length=50, side="left", mask=True)
    return t.select("idx", F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("ids"), F.size("attention_mask").cast("long").alias("n_mask"))


def _numbered(spark, d):
    """Word lengths, and beside them places and a mask: three lists of a row."""
    ids = F.transform(F.split(X.normalize_ws(F.col("text")), " "), lambda x: F.length(x))
    x = _docs(spark, d).select("idx", ids.alias("input_ids"))
    return x.withColumn("attention_mask", F.transform("input_ids", lambda _: F.lit(1))).withColumn("place", F.transform("input_ids", lambda _, i: i.cast("long")))


def _totals(p):
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    return p.select("batch", "block_no", total("input_ids").alias("total"), F.get("labels", 0).cast("long").alias("first_id"), total("attention_mask").alias("n_mask"), total("place").alias("places"), F.get("place", 127).alias("last_place"))


def pack_blocks(spark, d):
    return _totals(pack.pack_blocks(_numbered(spark, d), 128, 250))


def pack_blocks_fast(spark, d):
    return _totals(pack.pack_blocks_fast(_numbered(spark, d), 128, 250))


def prepare_clm(spark, d):
    p = pack.prepare_clm(_docs(spark, d).select("idx", "text"), 256, factory=_lengths, batch=500)
    return p.select("batch", "block_no", F.md5(F.concat_ws(" ", "input_ids")).alias("ids"))


def _lengths():
    """Words to their lengths: a tokenizer that SQL has too."""
    return lambda text: [len(w) for w in text.split()]


def prepare_chat(spark, d):
    """Whole conversations as the train split, rendered, shuffled and packed."""
    c = _convs(spark, d).select("idx", "messages")
    got = pack.prepare_chat([("conversations", "train", c, 1.0)], 64, factory=_lengths, batch=50)["train"]
    return got.select("batch", "block_no", F.md5(F.concat_ws(" ", "input_ids")).alias("ids"))


def scoreboard(spark, d):
    return relational.scoreboard(relational.flatten_scores(_scores(spark, d), {"ckpt-7": "ckpt-seven"}))


def scoreboard_compat(spark, d):
    return relational.scoreboard(relational.flatten_scores(_scores(spark, d)), compat=True).select("model", "average", "average_no_conll")


def checkpoint_series(spark, d):
    return relational.checkpoint_series(relational.flatten_scores(_scores(spark, d)), "ckpt-").select("dataset", "checkpoint", "metric", "value", "error")


QUERIES = {
    f.__name__: f
    for f in (
        curate_documents, normalize_ws, strip_lines, token_count, dedup_text, dedup_sequential, dedup_conversation, phrase_filter, planted_phrases, roman_filter, lid_filter,
        identify_language, glue, assistant_text, insert_system, render_sft, render_generation, render_rm, render_dpo,
        render_roles_program, render_chatml_program, render_inst_program, render_orpo_program, parse_conversation, answer_prompts,
        translate_prompts, converse_prompts, persona_bucket, answer_echo, translate_marks, converse_echo, answer_first_n, resume_antijoin, ledger_union, ledger_pivot, merge_original, failure_report,
        merge_revisions, mix, shuffle_md5, first_n, first_n_many, select_sorted, unpivot_columns, tokenize, tokenize_left, pack_blocks, pack_blocks_fast, prepare_clm, prepare_chat, scoreboard, scoreboard_compat,
        checkpoint_series,
    )
}

# ---- SQL ----

_WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _norm(c: str) -> str:
    return f"trim(regexp_replace({c}, '{_WS}+', ' ', 'g'))"


def _strip(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{_WS}+', ''), '{_WS}+$', '')"


def _tokens(c: str) -> str:
    return f"len(list_filter(string_split({_norm(c)}, ' '), lambda x: x <> ''))"


_LIDS = "CASE lang WHEN 'en' THEN 'eng_Latn' WHEN 'de' THEN 'deu_Latn' WHEN 'fr' THEN 'fra_Latn' WHEN 'es' THEN 'spa_Latn' END"
_LIT = "'<|' || role || '|>' || chr(10) || {} || '</s>' || chr(10)"
_ROLES = "role IN ('system', 'user', 'assistant')"
_RENDER = "coalesce(string_agg(CASE WHEN " + _ROLES + " THEN " + _LIT + " ELSE '' END, '' ORDER BY turn), '')"
_EMPTY_SYSTEM = "CASE WHEN arg_min(role, turn) <> 'system' THEN '<|system|>' || chr(10) || '</s>' || chr(10) ELSE '' END"
_IM = "'<|im_start|>' || role || chr(10) || {} || '<|im_end|>' || chr(10)"
_BRIEF = "'<|im_start|>system' || chr(10) || 'Be brief.<|im_end|>' || chr(10)"
_LASTS = "(SELECT *, max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations)"
_WORSE = "CASE WHEN turn = last THEN replace(text, 'e', '_') ELSE text END"


def _persona(seed: int, key: str, names: list[str], weights: list[float]) -> str:
    u = f"(('0x' || substr(md5('{seed}-' || {key}), 1, 8))::BIGINT / 4294967296.0)"
    out, total, upto = "CASE", sum(weights), 0.0
    for n, w in zip(names, weights, strict=True):
        upto += w
        out += f" WHEN {u} < {upto / total!r}::DOUBLE THEN '{n}'"
    return out + f" ELSE '{names[-1]}' END"


_LEDGER = "(SELECT doc_id AS idx, text AS question, CASE WHEN lang = 'en' THEN source ELSE '' END AS system FROM documents)"
_SCORES = """
    s AS (SELECT o_orderkey AS idx, 'ckpt-' || (o_custkey % 40) AS model,
                 ['dutch-social', 'conll-nl', 'scala-nl', 'squad-nl', 'wiki-lingua-nl', 'mmlu-nl', 'hellaswag-nl'][((o_orderkey // 8) % 7) + 1] AS dataset,
                 (o_custkey % 1000) / 1000.0::DOUBLE AS score FROM orders),
    f AS (SELECT * FROM (SELECT {alias} AS model, dataset, score, row_number() OVER (PARTITION BY {alias}, dataset ORDER BY idx) AS rn FROM s) WHERE rn = 1),
    w AS (SELECT model, {cells} FROM f GROUP BY model HAVING count(*) = 7)
"""  # noqa: E501


def _score_sql(alias: str) -> str:
    cells = ", ".join(f"max(score) FILTER (WHERE dataset = '{d}') AS \"{d}_{m}\"" for d, m in relational.METRICS.items())
    return "WITH" + _SCORES.format(alias=alias, cells=cells)


_COLS = [f'"{d}_{m}"' for d, m in relational.METRICS.items()]
_AVG = "((" + " + ".join(_COLS) + ") / 7)"
_REST = " + ".join(c for c in _COLS if "conll" not in c)
_BLOCK_TOKENS = f"SELECT doc_id AS idx, unnest(string_split({_norm('text')}, ' ')) AS t, generate_subscripts(string_split({_norm('text')}, ' '), 1) AS p FROM documents"

_PACKED = f"""
        WITH t AS ({_BLOCK_TOKENS}),
        r AS (SELECT idx // 250 AS batch, length(t) AS v, p - 1 AS place, row_number() OVER (PARTITION BY idx // 250 ORDER BY idx, p) - 1 AS rn FROM t)
        SELECT batch, rn // 128 AS block_no, sum(v)::BIGINT AS total, arg_min(v, rn)::BIGINT AS first_id, count(*) AS n_mask, sum(place)::BIGINT AS places, arg_max(place, rn)::BIGINT AS last_place
        FROM r GROUP BY 1, 2 HAVING count(*) = 128"""


def _char(k: int) -> str:
    """Code point of the k-th character of w from either end, 0 where there is none."""
    at = str(k) if k > 0 else f"length(w) - {-k - 1}"
    return f"CASE WHEN length(w) >= {abs(k)} THEN unicode(substr(w, {at}, 1)) ELSE 0 END"


ORACLE: dict[str, str] = {
    "curate_documents": f"""
        WITH n AS (SELECT doc_id, {_norm('text')} AS text, {_LIDS} AS lid FROM documents),
        u AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM n)
        SELECT doc_id, md5(text) AS text_md5, {_tokens('text')}::BIGINT AS n_tokens FROM u
        WHERE rn = 1 AND NOT regexp_matches(text, '{quality.phrase_pattern().replace('(?iu)', '(?i)')}') AND (lid = 'eng_Latn' OR {_tokens('text')} <= 3)""",
    "normalize_ws": f"SELECT doc_id, {_norm('text')} AS norm FROM documents",
    "strip_lines": f"""
        SELECT doc_id, count(*) AS n_lines, sum(length({_strip('line')}))::BIGINT AS n_stripped
        FROM (SELECT doc_id, unnest(string_split(regexp_replace(text, '\\n$', ''), chr(10))) AS line FROM documents WHERE text <> '') GROUP BY doc_id""",
    "token_count": f"SELECT doc_id, {_tokens('text')}::BIGINT AS n_tokens FROM documents",
    "dedup_text": "SELECT min(doc_id) AS doc_id FROM documents GROUP BY text",
    "dedup_sequential": """
        WITH a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1),
        b AS (SELECT *, row_number() OVER (PARTITION BY n_chars ORDER BY doc_id) AS r2 FROM a)
        SELECT doc_id, source FROM b WHERE r2 = 1""",
    "dedup_conversation": f"""
        WITH t AS (SELECT conv_id, {_strip("coalesce(string_agg(text, ' ' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')")} AS k FROM conversations GROUP BY conv_id)
        SELECT min(conv_id) AS conv_id FROM t GROUP BY k""",
    "phrase_filter": f"SELECT doc_id FROM documents WHERE NOT regexp_matches({_norm('text')}, '(?i)als (?:een )?loser|loser ben|the|OpenAI|sorry|was')",
    "planted_phrases": f"""
        WITH p AS (SELECT doc_id, text || CASE doc_id % 8 {' '.join(f"WHEN {i} THEN chr(10) || '{p}'" for i, p in enumerate(PLANTED))} ELSE '' END AS text FROM documents)
        SELECT doc_id FROM p WHERE NOT regexp_matches({_norm('text')}, '{quality.phrase_pattern().replace('(?iu)', '(?i)')}')""",
    "roman_filter": "SELECT doc_id FROM documents WHERE doc_id % 20 >= 6",
    "lid_filter": f"SELECT doc_id, lang FROM documents WHERE {_LIDS} = 'deu_Latn' OR doc_id % 4 = 0 OR {_tokens('text')} <= 3",
    "glue": "SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS text FROM conversations GROUP BY conv_id",
    "assistant_text": f"SELECT conv_id, {_strip("coalesce(string_agg(text, ' ' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')")} AS text FROM conversations GROUP BY conv_id",
    "insert_system": """
        SELECT conv_id, count(*) + (CASE WHEN arg_min(role, turn) <> 'system' THEN 1 ELSE 0 END) AS n, 'system' AS first_role,
               CASE WHEN arg_min(role, turn) <> 'system' THEN '' ELSE arg_min(text, turn) END AS first_content FROM conversations GROUP BY conv_id""",
    "render_sft": f"SELECT conv_id, {_EMPTY_SYSTEM} || {_RENDER.format('text')} AS text FROM conversations GROUP BY conv_id",
    "render_generation": f"SELECT conv_id, {_RENDER.format('text')} || '<|assistant|>' || chr(10) AS text FROM conversations GROUP BY conv_id",
    "render_rm": f"SELECT conv_id, {_EMPTY_SYSTEM} || {_RENDER.format('text')} AS text_chosen, {_EMPTY_SYSTEM} || {_RENDER.format(_WORSE)} AS text_rejected FROM {_LASTS} GROUP BY conv_id",
    "render_dpo": f"""
        SELECT conv_id, coalesce(string_agg({_LIT.format('text')}, '' ORDER BY turn) FILTER (WHERE turn < last), '') AS text_prompt,
               string_agg({_LIT.format('text')}, '') FILTER (WHERE turn = last) AS text_chosen,
               string_agg({_LIT.format("replace(text, 'e', '_')")}, '') FILTER (WHERE turn = last) AS text_rejected FROM {_LASTS} GROUP BY conv_id""",
    "render_roles_program": f"SELECT conv_id, {_EMPTY_SYSTEM} || {_RENDER.format('text')} || '<|assistant|>' || chr(10) AS text FROM conversations GROUP BY conv_id",
    "render_chatml_program": f"""
        SELECT conv_id, CASE WHEN arg_min(role, turn) <> 'system' THEN {_BRIEF} ELSE '' END || string_agg({_IM.format('text')}, '' ORDER BY turn) || '<|im_start|>assistant' || chr(10) AS text
        FROM conversations GROUP BY conv_id""",
    "render_inst_program": f"""
        WITH s AS (SELECT conv_id, arg_min(role, turn) = 'system' AS has, {_strip('arg_min(text, turn)')} AS system FROM conversations GROUP BY conv_id),
        t AS (SELECT c.conv_id, role, text, has, system, turn, row_number() OVER (PARTITION BY c.conv_id ORDER BY turn) AS r FROM conversations c JOIN s USING (conv_id)),
        u AS (SELECT *, CASE WHEN has AND r = 2 THEN '<<SYS>>' || chr(10) || system || chr(10) || '<</SYS>>' || chr(10) || chr(10) || text ELSE text END AS content FROM t WHERE NOT (has AND r = 1))
        SELECT conv_id, string_agg(CASE role WHEN 'user' THEN '<s>[INST] ' || {_strip('content')} || ' [/INST]' ELSE ' ' || {_strip('text')} || ' </s>' END, '' ORDER BY turn) AS text
        FROM u GROUP BY conv_id""",
    "render_orpo_program": f"""
        SELECT conv_id, CASE WHEN count(*) = 1 THEN '' WHEN arg_min(role, turn) <> 'system' THEN {_BRIEF} ELSE '' END || coalesce(string_agg({_IM.format('text')}, '' ORDER BY turn) FILTER (WHERE turn < last), '') AS text_prompt,
               {_BRIEF} || string_agg({_IM.format('text')}, '') FILTER (WHERE turn = last) AS text_chosen,
               {_BRIEF} || string_agg({_IM.format("replace(text, 'e', '_')")}, '') FILTER (WHERE turn = last) AS text_rejected FROM {_LASTS} GROUP BY conv_id""",
    "parse_conversation": f"""
        WITH t AS (SELECT conv_id, turn, role, {_strip('text')} AS content FROM conversations WHERE role <> 'system'),
        u AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM t WHERE content <> '')
        SELECT conv_id, pos::BIGINT AS pos, role, content FROM u WHERE NOT (back = 1 AND role <> 'assistant')""",
    "answer_prompts": "SELECT doc_id AS idx, 'response' AS \"column\", 'system=' || source || '|user=' || text AS prompt FROM documents",
    "translate_prompts": " UNION ALL ".join(f"SELECT doc_id AS idx, '{c}' AS \"column\", 'system=From English to Dutch|user=' || {_strip(c)} AS prompt FROM documents WHERE {_strip(c)} <> ''" for c in ("text", "source")),
    "converse_prompts": f"""
        WITH p AS (SELECT doc_id AS idx, source, {_persona(42, "'train-' || doc_id", ['teacher', 'nurse', 'pilot'], [5, 3, 2])} AS persona FROM documents)
        SELECT idx, persona, 'system=Talk about ' || source || ' as a ' || persona || '. Begin turns with user: or assistant: only.' AS prompt FROM p""",
    "persona_bucket": f"SELECT {_persona(7, 'doc_id', ['a', 'b', 'c'], [5, 3, 2])} AS persona, count(*) AS n FROM documents GROUP BY 1",
    "answer_echo": f"SELECT doc_id AS idx, text AS question, regexp_replace(text, '^{_WS}+|{_WS}+$', '', 'g') AS response FROM documents",
    "translate_marks": f"""
        SELECT doc_id AS idx, CASE WHEN doc_id % 6 <> 0 AND {_strip('text')} <> '' THEN {_strip('text')} || ' !' ELSE '' END AS text_dutch, {_strip("coalesce(source, 'none')")} || ' !' AS source_dutch FROM documents""",
    "converse_echo": f"""
        WITH p AS (SELECT doc_id AS idx, coalesce(source, 'none') AS source, {_persona(42, "'train-' || doc_id", ['teacher', 'nurse', 'pilot'], [5, 3, 2])} AS persona FROM documents)
        SELECT idx, persona, 'user=Talk about ' || source || '.|assistant=I, a ' || persona || ', will.' AS turns FROM p""",
    "answer_first_n": """
        SELECT split, doc_id AS idx, lang || ' !' AS response FROM (SELECT *, CASE WHEN lang = 'en' THEN 'train' ELSE 'test' END AS split FROM documents)
        QUALIFY row_number() OVER (PARTITION BY split ORDER BY doc_id) <= 70""",
    "resume_antijoin": "SELECT doc_id AS idx, source FROM documents WHERE doc_id % 3 <> 0",
    "ledger_union": "SELECT 'train' AS split, 'c' AS \"column\", count(*) AS n, sum(doc_id)::BIGINT AS sum_idx FROM documents WHERE doc_id % 2 = 0 OR doc_id % 3 = 0",
    "ledger_pivot": f"SELECT idx, question, system FROM {_LEDGER}",
    "merge_original": f"SELECT l.idx, d.lang, l.question, l.system FROM {_LEDGER} l JOIN documents d ON l.idx = d.doc_id",
    "failure_report": """
        SELECT count(*) FILTER (WHERE event_id % 7 = 0) AS rate_limit, count(*) FILTER (WHERE event_id % 7 = 1) AS empty,
               count(*) FILTER (WHERE event_id % 7 IN (2, 3, 4)) AS time_out, count(*) AS total FROM events""",
    "merge_revisions": """
        WITH x AS (SELECT *, CASE WHEN length(text) >= 100 THEN md5(text) END AS k FROM documents),
        a AS (SELECT * FROM (SELECT k, lang, n_chars AS n, row_number() OVER (PARTITION BY k ORDER BY doc_id) AS rn FROM x) WHERE rn = 1),
        b AS (SELECT * FROM (SELECT k, source, CASE WHEN lang <> 'fr' THEN n_chars END AS n, row_number() OVER (PARTITION BY k ORDER BY doc_id) AS rn FROM x) WHERE rn = 1)
        SELECT a.k, a.lang, a.n AS n_x, b.source, b.n AS n_y FROM a JOIN b ON a.k IS NOT DISTINCT FROM b.k
        WHERE a.lang IS NOT NULL AND a.n IS NOT NULL AND b.source IS NOT NULL AND b.n IS NOT NULL""",
    "mix": """
        SELECT 'docs' AS dataset, doc_id AS idx, source, 'train' AS kind FROM documents WHERE doc_id < floor(0.29::DOUBLE * (SELECT count(*) FROM documents))
        UNION ALL SELECT 'pages', page_id, url, 'train' FROM pages WHERE page_id < floor(0.5 * (SELECT count(*) FROM pages))
        UNION ALL SELECT 'benchmark', item_id, text, 'test' FROM benchmark""",
    "shuffle_md5": "SELECT event_id, row_number() OVER (ORDER BY md5('42-' || event_id), event_id) - 1 AS idx FROM events",
    "identify_language": f"""
        WITH w AS (SELECT doc_id, lang, unnest(list_filter(string_split({_norm('lower(text)')}, ' '), lambda x: x <> '')) AS w FROM documents),
        g AS (SELECT doc_id, lang, ({_char(1)} * 961 + {_char(2)} * 31 + {_char(3)}) % 4096 AS b FROM w
              UNION ALL SELECT doc_id, lang, 4096 + ({_char(-1)} * 961 + {_char(-2)} * 31 + {_char(-3)}) % 4096 FROM w),
        c AS (SELECT lang, b, count(*) AS c FROM g WHERE doc_id % 5 <> 0 AND lang IS NOT NULL GROUP BY lang, b),
        l AS (SELECT lang, coalesce(sum(c), 0) AS total FROM (SELECT DISTINCT lang FROM documents WHERE doc_id % 5 <> 0 AND lang IS NOT NULL AND text IS NOT NULL) LEFT JOIN c USING (lang) GROUP BY lang),
        m AS (SELECT l.lang, r.b, floor(1000 * ln((coalesce(c.c, 0) + 0.5::DOUBLE) / (total + 4096)))::BIGINT AS weight FROM l CROSS JOIN (SELECT range AS b FROM range(8192)) r LEFT JOIN c ON c.lang = l.lang AND c.b = r.b),
        k AS (SELECT doc_id, b, count(*) AS n FROM g GROUP BY doc_id, b),
        s AS (SELECT doc_id, m.lang, sum(n * weight)::BIGINT AS s FROM k JOIN m USING (b) GROUP BY doc_id, m.lang),
        t AS (SELECT doc_id, max(s) AS top FROM s GROUP BY doc_id),
        f AS (SELECT doc_id, arg_min(lang, (top - s, lang)) AS lid, 1.0::DOUBLE / sum(exp((s - top) / 1000.0::DOUBLE)) AS prob FROM s JOIN t USING (doc_id) GROUP BY doc_id)
        SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(f.lid, 'und_Latn') END AS text_lid, CASE WHEN d.text IS NOT NULL THEN round(coalesce(f.prob, 0), 6) END AS text_lid_prob
        FROM documents d LEFT JOIN f USING (doc_id)""",
    "first_n": """
        SELECT split, doc_id AS idx, lang, source FROM (SELECT *, CASE WHEN lang = 'en' THEN 'train' ELSE 'test' END AS split FROM documents)
        QUALIFY row_number() OVER (PARTITION BY split ORDER BY doc_id) <= 100""",
    "first_n_many": """
        SELECT split, event_id * 3 AS idx FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'a' ELSE 'b' END AS split FROM events)
        QUALIFY row_number() OVER (PARTITION BY split ORDER BY event_id) <= 2000""",
    "select_sorted": "SELECT doc_id, lang, source FROM documents",
    "unpivot_columns": "SELECT doc_id AS idx, 'lang' AS \"column\", lang AS text FROM documents UNION ALL SELECT doc_id, 'source', source FROM documents",
    "tokenize": f"SELECT doc_id AS idx, {_tokens('text')}::BIGINT AS n FROM documents",
    "tokenize_left": f"""
        WITH t AS (SELECT doc_id, list_transform(list_filter(string_split({_norm('text')}, ' '), lambda x: x <> ''), lambda x: length(x)) AS l FROM documents)
        SELECT doc_id AS idx, array_to_string(list_slice(l, greatest(1, len(l) - 49), len(l)), ' ') AS ids, least(50, len(l))::BIGINT AS n_mask FROM t""",
    "pack_blocks": _PACKED,
    "pack_blocks_fast": _PACKED,
    "prepare_clm": f"""
        WITH o AS (SELECT doc_id, text, row_number() OVER (ORDER BY md5('42-' || doc_id), doc_id) - 1 AS idx FROM documents),
        t AS (SELECT idx, unnest(string_split({_norm('text')}, ' ')) AS t, generate_subscripts(string_split({_norm('text')}, ' '), 1) AS p FROM o),
        r AS (SELECT idx // 500 AS batch, length(t) AS v, row_number() OVER (PARTITION BY idx // 500 ORDER BY idx, p) - 1 AS rn FROM t WHERE t <> '')
        SELECT batch, rn // 256 AS block_no, md5(string_agg(v, ' ' ORDER BY rn)) AS ids FROM r GROUP BY 1, 2 HAVING count(*) = 256""",
    "prepare_chat": f"""
        WITH c AS (SELECT conv_id, {_EMPTY_SYSTEM} || {_RENDER.format('text')} AS text FROM conversations GROUP BY conv_id),
        o AS (SELECT text, row_number() OVER (ORDER BY md5('42-conversations-' || conv_id), conv_id) - 1 AS idx FROM c),
        t AS (SELECT idx, unnest(string_split({_norm('text')}, ' ')) AS t, generate_subscripts(string_split({_norm('text')}, ' '), 1) AS p FROM o),
        r AS (SELECT idx // 50 AS batch, length(t) AS v, row_number() OVER (PARTITION BY idx // 50 ORDER BY idx, p) - 1 AS rn FROM t WHERE t <> '')
        SELECT batch, rn // 64 AS block_no, md5(string_agg(v, ' ' ORDER BY rn)) AS ids FROM r GROUP BY 1, 2 HAVING count(*) = 64""",
    "scoreboard": _score_sql("CASE model WHEN 'ckpt-7' THEN 'ckpt-seven' ELSE model END") + f"SELECT *, {_AVG} AS average, ({_REST}) / 6 AS average_no_conll FROM w",
    "scoreboard_compat": _score_sql("model") + f"SELECT model, {_AVG} AS average, ({_REST} + {_AVG}) / 7 AS average_no_conll FROM w",
    "checkpoint_series": _score_sql("model") + """
        SELECT dataset, replace(model, 'ckpt-', '')::INTEGER AS checkpoint, CASE dataset WHEN 'dutch-social' THEN 'test_macro_f1' WHEN 'conll-nl' THEN 'test_micro_f1'
            WHEN 'scala-nl' THEN 'test_macro_f1' WHEN 'squad-nl' THEN 'test_f1' WHEN 'wiki-lingua-nl' THEN 'test_bertscore' ELSE 'test_accuracy' END AS metric,
            score AS value, 0.5::DOUBLE AS error FROM f""",
}
