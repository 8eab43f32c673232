"""Command line: answer, translate, converse, fit-lid, lid, filter, merge, clm, chat, scores, snapshot, publish, failures and repl."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from weir.functions.messages import ZEPHYR
from weir.functions.template import ProgramTemplate
from weir.operators import generate, language, pack, quality, relational
from weir.operators.metrics import RowCounts
from weir.sources import io, plots, workbook
from weir.sources.revisions import Revisions


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="weir")
    sub = top.add_subparsers(dest="command", required=True)

    def add(name: str, *, model: bool = False) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        p.add_argument("--dataset", required=True, help="folder of the dataset")
        p.add_argument("--output", required=True)
        p.add_argument("--split", action="append")
        if model:
            p.add_argument("--ledger", required=True)
            p.add_argument("--hf-model")
            p.add_argument("--use-vllm", action="store_true")
            p.add_argument("--credentials")
            p.add_argument("--profile", action="append")
            p.add_argument("--echo", action="store_true", help="answer with the first message, without a model")
            p.add_argument("--max-workers", type=int, default=1)
            p.add_argument("--max-retries", type=int, default=3)
            p.add_argument("--timeout", type=float, default=30.0)
            p.add_argument("--max-tokens", type=int, default=2048)
            p.add_argument("--max-samples", type=int)
            p.add_argument("--no-merge", action="store_true")
            p.add_argument("--max-calls", type=int, help="most calls that are open at a time, over all executors")
            p.add_argument("--only-save-current", action="store_true", help="ask nothing, write what the ledger has")
        return p

    p = add("answer", model=True)
    p.add_argument("--user-column", required=True)
    p.add_argument("--system-column")
    p.add_argument("--system-message")
    p.add_argument("--response-column", default="response")
    p = add("translate", model=True)
    p.add_argument("--column", action="append")
    p.add_argument("--src-lang")
    p.add_argument("--tgt-lang")
    p.add_argument("--system-prompt", default=generate.TRANSLATION_PROMPT)
    p = add("converse", model=True)
    p.add_argument("--seed-column", required=True)
    p.add_argument("--system-prompt", required=True)
    p.add_argument("--user-id", default="user: ")
    p.add_argument("--assistant-id", default="assistant: ")
    p.add_argument("--personas")
    p.add_argument("--output-column", default="messages")
    for name in ("lid", "filter"):
        p = add(name)
        p.add_argument("--column", action="append", required=True)
        p.add_argument("--model", help="language model file: of fit-lid (.json) or fastText")
    sub.choices["filter"].add_argument("--target", default="nld_Latn")
    p = add("fit-lid")
    p.add_argument("--text-column", default="text")
    p.add_argument("--label-column", required=True)
    p.add_argument("--max-rows", type=int, help="fit on a sample of about that many rows; without it on all")
    p = add("merge")
    p.add_argument("--revision", action="append", required=True)
    p.add_argument("--on", action="append", required=True)
    p = add("clm")
    p.add_argument("--text-column", default="text")
    p.add_argument("--block-size", type=int, required=True)
    p.add_argument("--tokenizer")
    p = add("chat")
    p.add_argument("--more", action="append", default=[], help="another dataset, --dataset being the first")
    p.add_argument("--config", action="append", help="a configuration for each dataset, - for none")
    p.add_argument("--fraction", type=float, action="append", help="of the train splits, one for each dataset")
    p.add_argument("--task-name", choices=["sft", "generation", "rm", "dpo", "orpo"], default="sft")
    p.add_argument("--block-size", type=int, required=True)
    p.add_argument("--tokenizer")
    p.add_argument("--template", help="file of a chat template program")
    p.add_argument("--no-system", action="store_true", help="do not put an empty system turn first")
    p.add_argument("--max-length", type=int)
    p.add_argument("--truncation-side", choices=["left", "right"], default="left")
    p = add("scores")
    p.add_argument("--compat", action="store_true")
    p.add_argument("--workbook", help="also the single scores, a sheet for each dataset of this .xlsx file")
    p.add_argument("--plots", help="folder of line plots over checkpoints")
    p.add_argument("--prefix", default="checkpoint-", help="what stands before a checkpoint's number")
    p = add("snapshot")
    p.add_argument("--allow", action="append")
    p.add_argument("--ignore", action="append")
    p.add_argument("--every", type=float, default=60.0)
    p.add_argument("--most", type=float, help="seconds after which to give up")
    p = add("publish")
    p.add_argument("--name", required=True)
    p.add_argument("--config")
    p.add_argument("--revision", default="main")
    p = sub.add_parser("failures")
    p.add_argument("--ledger", required=True)
    p = sub.add_parser("repl")
    p.add_argument("--hf-model")
    p.add_argument("--use-vllm", action="store_true")
    p.add_argument("--credentials")
    p.add_argument("--profile", action="append")
    p.add_argument("--system-prompt")
    p.add_argument("--echo", action="store_true")
    p.add_argument("--max-tokens", type=int, default=2048)
    p.add_argument("--max-retries", type=int, default=3)
    p.add_argument("--timeout", type=float, default=30.0)
    p.add_argument("--model", action="append", help="deployment or model of the service")
    p.add_argument("--json-mode", action="store_true")
    p.add_argument("--temperature", type=float, default=1.0)
    p.add_argument("--top-k", type=int, default=50)
    p.add_argument("--top-p", type=float, default=1.0)
    p.add_argument("--load-in-8bit", action="store_true")
    p.add_argument("--load-in-4bit", action="store_true")
    return top


def factory(a: argparse.Namespace):
    if a.echo:
        return generate.EchoGenerator
    creds = generate.load_credentials(a.credentials, a.profile) if a.credentials else None
    how = {k: getattr(a, k) for k in ("max_workers", "max_retries", "timeout") if hasattr(a, k)}
    if a.hf_model:
        how |= {k: getattr(a, k) for k in ("temperature", "top_k", "top_p", "load_in_8bit", "load_in_4bit") if hasattr(a, k)}
        how |= {"max_new_tokens": a.max_tokens} if hasattr(a, "max_tokens") else {}
    elif creds:
        how |= {k: v for k, v in (("max_tokens", getattr(a, "max_tokens", None)), ("models", getattr(a, "model", None)), ("json_mode", getattr(a, "json_mode", None))) if v is not None}
    generate.choose_generator(a.hf_model, creds, a.use_vllm, **how)  # wrong settings fail here, not on an executor
    return lambda: generate.choose_generator(a.hf_model, creds, a.use_vllm, **how)


def repl(generator, system_prompt: str | None = None, read=input, write=print) -> None:
    """A conversation that grows until ``exit``; ``restart`` clears it, the system prompt too."""
    start = [{"role": "system", "content": system_prompt}] if system_prompt else []
    history = list(start)
    while (text := read("> ").strip()) != "exit":
        if text == "restart":
            history = []
            continue
        history.append({"role": "user", "content": text})
        got = generator.query_messages(history)
        write(got.text_response if got.error is None else got.error)
        history.append({"role": "assistant", "content": got.text_response or ""})


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(args)
    if a.command == "repl":
        return repl(factory(a)(), a.system_prompt)
    spark = spark or SparkSession.builder.appName("weir").getOrCreate()
    if a.command == "failures":
        relational.failure_report(generate.read_ledger(spark, f"{a.ledger}/failed", generate.ledger_schema("x string")[1])).show()
        return None
    if a.command == "scores":
        board = relational.scoreboard(relational.flatten_scores(io.read_records(spark, a.dataset)), compat=a.compat)
        board.toPandas().to_csv(a.output, index=False)
        if a.workbook:
            scores = relational.flatten_scores(io.read_records(spark, a.dataset))
            single = scores.select("dataset", "model", F.explode("total").alias("metric", "value")).groupBy("dataset", "model").pivot("metric").agg(F.first("value"))
            workbook.write_workbook(single, "dataset", a.workbook)
        if a.plots:
            plots.write_plots(relational.checkpoint_series(relational.flatten_scores(io.read_records(spark, a.dataset)), a.prefix), a.plots)
        return None
    if a.command == "snapshot":
        found = io.snapshot(spark, a.dataset, a.allow, a.ignore, a.every, a.most)
        with open(a.output, "w", encoding="utf-8") as f:
            f.writelines(f"{p}\n" for p in found)
        return None
    if a.command == "publish":
        entry = Revisions(spark, a.output, a.name, a.config).publish(io.read_dataset(spark, a.dataset, a.split), a.revision)
        print(f"{a.name} {entry.ref} {entry.number}: {entry.rows}")
        return None
    if a.command == "chat":
        return chat(spark, a)
    if a.command == "merge":
        frames = [io.read_dataset(spark, f"{a.dataset}/{r}", a.split) for r in a.revision]
        out = relational.merge_revisions([f.select(*relational.common_columns(frames)) for f in frames], ["split", *a.on])
        return io.write_dataset(out, a.output)
    df = io.read_dataset(spark, a.dataset, a.split)
    if a.command == "fit-lid":
        return language.fit_language_model(df, a.text_column, a.label_column, a.max_rows).save(a.output)
    more = {"most_calls": a.max_calls, "only_save_current": a.only_save_current} if hasattr(a, "max_calls") else {}
    counts = None
    if a.command == "answer":
        out = generate.answer(df, factory(a), a.ledger, a.user_column, a.system_column, a.system_message, a.response_column, a.max_samples, not a.no_merge, **more)
    elif a.command == "translate":
        out = generate.translate(df, factory(a), a.ledger, a.column, a.src_lang, a.tgt_lang, a.system_prompt, a.max_samples, not a.no_merge, **more)
    elif a.command == "converse":
        out = generate.converse(df, factory(a), a.ledger, a.seed_column, a.system_prompt, a.user_id, a.assistant_id, a.personas, a.output_column, a.max_samples, not a.no_merge, **more)
    elif a.command in ("lid", "filter"):
        model = quality.STAND_IN if not a.model else language.NgramModel.load(a.model) if a.model.endswith(".json") else quality.fasttext_model(a.model)
        if a.command == "lid":
            out = quality.identify_language(df, a.column, model)
        else:
            counts = RowCounts()
            once = relational.dedup_sequential(counts.at(df, "read"), a.column, within=["split"])
            out = quality.quality_filter(once, a.column, a.target, model=model, counts=counts)
    else:
        out = pack.prepare_clm(df, a.block_size, a.text_column, pack.file_tokenizer(a.tokenizer) if a.tokenizer else pack.hash_tokenizer)
        return out.write.parquet(a.output)
    io.write_dataset(out, a.output)
    if counts is not None:
        print(counts)
    return None


def chat(spark: SparkSession, a: argparse.Namespace) -> None:
    """Mixes the splits of some datasets, renders, tokenizes and packs them, and writes train and test."""
    configs = None if a.config is None else [None if c == "-" else c for c in a.config]
    parts = []
    for dataset, config, fraction in io.pair_configs([a.dataset, *a.more], configs, a.fraction):
        folder = f"{dataset}/{config}" if config else dataset
        names = [n.removeprefix("split=") for n in io.children(spark, folder)]
        for split in a.split or names:
            parts.append((folder, split, io.read_split(spark, folder, split), fraction))
    template = ZEPHYR
    if a.template:
        with open(a.template, encoding="utf-8") as f:
            template = ProgramTemplate(f.read())
    tok = pack.file_tokenizer(a.tokenizer) if a.tokenizer else pack.hash_tokenizer
    done = pack.prepare_chat(parts, a.block_size, a.task_name, tok, template=template, auto_system=not a.no_system, max_length=a.max_length, side=a.truncation_side)
    for kind, blocks in done.items():
        blocks.write.parquet(f"{a.output}/{kind}")


if __name__ == "__main__":
    main(sys.argv[1:])
