"""Conversations as arrays of struct<role, content>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.functions.text import split_lines, strip

MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
MESSAGES = T.ArrayType(MESSAGE)
DDL = "array<struct<role:string,content:string>>"


def is_messages(kind: T.DataType) -> bool:
    """Whether a column's type is a list of messages; looked at once, not per row."""
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) and {"role", "content"} <= set(kind.elementType.names)


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.cast("string").alias("content"))


def glue(m: Column) -> Column:
    """All contents joined by spaces."""
    return F.concat_ws(" ", F.transform(m, lambda x: x["content"]))


def assistant_text(m: Column) -> Column:
    """The assistant's contents joined by spaces and stripped."""
    return strip(F.concat_ws(" ", F.transform(F.filter(m, lambda x: x["role"] == "assistant"), lambda x: x["content"])))


def text_of(name: str, kind: T.DataType) -> Column:
    return glue(F.col(name)) if is_messages(kind) else F.col(name).cast("string")


def answer_prompt(user: Column, system: Column | None = None, system_message: str | None = None) -> Column:
    """[system?, user]; a system column and a system message exclude each other."""
    if system is not None and system_message is not None:
        raise ValueError("give a system column or a system message, not both")
    parts = [message("user", user)]
    if system is not None or system_message is not None:
        parts.insert(0, message("system", system if system is not None else F.lit(system_message)))
    return F.array(*parts)


def parse_conversation(text: Column, user_id: str = "user:", assistant_id: str = "assistant:", drop_last: bool = True) -> Column:
    """Turns that begin with lines starting with either id.

    Text before the first id is dropped, other lines belong to the turn above, contents are
    stripped and turns without content left out.  With ``drop_last`` one last
    turn that is not the assistant's goes.
    """
    none = F.lit(None).cast("string")
    start = F.struct(none.alias("role"), F.lit("").alias("content"), F.array().cast(DDL).alias("done"))

    def closed(s: Column) -> Column:
        body = strip(s["content"])
        one = F.array(F.struct(s["role"].alias("role"), body.alias("content")))
        return F.when(s["role"].isNotNull() & (body != ""), F.concat(s["done"], one)).otherwise(s["done"])

    def step(s: Column, line: Column) -> Column:
        def turn(role: str, mark: str) -> Column:
            return F.struct(F.lit(role).alias("role"), F.substring(line, F.lit(len(mark) + 1), F.length(line)).alias("content"), closed(s).alias("done"))

        more = F.struct(s["role"].alias("role"), F.concat(s["content"], line).alias("content"), s["done"].alias("done"))
        return F.when(line.startswith(user_id), turn("user", user_id)).when(line.startswith(assistant_id), turn("assistant", assistant_id)).otherwise(more)

    out = F.aggregate(split_lines(text), start, step, closed)
    if not drop_last:
        return out
    return F.aggregate(F.array(out), F.array().cast(DDL), lambda _, m: F.when((F.size(m) > 0) & (F.element_at(m, -1)["role"] != "assistant"), F.slice(m, 1, F.size(m) - 1)).otherwise(m))


def insert_system(m: Column, template: str = "system") -> Column:
    """An empty system turn first, where there is none and the template speaks of one."""
    if "system" not in template and "<|im_start|>" not in template:
        return m
    empty = F.array(message("system", F.lit("")))
    return F.when((F.size(m) > 0) & (F.get(m, 0)["role"] != "system"), F.concat(empty, m)).otherwise(m)


class ChatTemplate:
    """role -> (prefix, suffix) around each content, and what asks for an answer."""

    def __init__(self, roles: dict[str, tuple[str, str]] | None = None, generation: str = "<|assistant|>\n", eos: str = "</s>"):
        self.roles = roles or {r: (f"<|{r}|>\n", f"{eos}\n") for r in ("system", "user", "assistant")}
        self.generation = generation

    @property
    def source(self) -> str:
        return "".join(self.roles) + "".join(a + b for a, b in self.roles.values())

    def render(self, m: Column, generation: bool = False) -> Column:
        def one(x: Column) -> Column:
            out = F.lit("")
            for role, (a, b) in self.roles.items():
                out = F.when(x["role"] == role, F.concat(F.lit(a), x["content"], F.lit(b))).otherwise(out)
            return out

        body = F.array_join(F.transform(m, one), "")
        return F.concat(body, F.lit(self.generation)) if generation else body


ZEPHYR = ChatTemplate()


def render_chat(df, task: str = "sft", template: ChatTemplate = ZEPHYR, auto_system: bool = True, messages: str = "messages"):
    """Adds text for sft and generation, text_chosen and text_rejected for rm, and text_prompt too for dpo and orpo."""
    system = (lambda m: insert_system(m, template.source)) if auto_system else (lambda m: m)
    if task in ("sft", "generation"):
        return df.withColumn("text", template.render(system(F.col(messages)), task == "generation"))
    if task not in ("rm", "dpo", "orpo"):
        raise ValueError(f"task {task} is none of sft, generation, rm, dpo, orpo")
    for name in ("chosen", "rejected"):
        if name not in df.columns or not is_messages(df.schema[name].dataType):
            raise ValueError(f"task {task} needs messages in chosen and rejected")
    if task == "rm":
        return df.withColumns({f"text_{n}": template.render(system(F.col(n))) for n in ("chosen", "rejected")})
    last = lambda n: F.slice(n, F.size(n), 1)
    if "prompt" in df.columns and is_messages(df.schema["prompt"].dataType):
        prompt, chosen, rejected = F.col("prompt"), F.col("chosen"), F.col("rejected")
    else:
        prompt, chosen, rejected = F.slice("chosen", F.lit(1), F.size("chosen") - 1), last("chosen"), last("rejected")
    return df.withColumns({"text_prompt": template.render(system(prompt)), "text_chosen": template.render(chosen), "text_rejected": template.render(rejected)})
