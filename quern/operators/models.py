"""Model calls as pluggable functions: language models, embeddings, translation, OCR and rendering.

A client is any picklable callable. The engine supplies batching, retries, the fallback for missing results and an error
contract; deterministic stand-ins serve tests and machines without models.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern import scratch
from quern.functions import text as T
from quern.functions.records import token_budget

Client = Callable[[str, int], str]
EMBEDDING_SIZE = 64


def echo_client(prompt: str, max_tokens: int) -> str:
    """A stand-in model: lists the first words of the prompt's lines, the same for the same prompt."""
    lines = [x.strip() for x in prompt.splitlines() if x.strip()]
    return "\n".join(f"- {' '.join(x.split()[:8])}" for x in lines[: max(1, max_tokens // 400)])


def ask(df: DataFrame, prompt: str, client: Client, attempts: int = 3, pause_s: float = 0.0) -> DataFrame:
    """Adds response, error and seconds. A call that raises or returns nothing is tried again; the last error is kept."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", response string, error string, seconds double"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            responses, errors, seconds = [], [], []
            for text, budget in zip(frame[prompt], frame["_budget"], strict=True):
                began, response, error = time.monotonic(), None, None
                for k in range(attempts):
                    try:
                        response = client(text, int(budget)) or None
                        error = None if response else "empty response"
                    except Exception as e:  # the client's own errors are data here
                        error = f"{type(e).__name__}: {e}"
                    if response:
                        break
                    time.sleep(pause_s * 2**k)
                responses.append(response)
                errors.append(error)
                seconds.append(time.monotonic() - began)
            yield frame.drop(columns="_budget").assign(response=responses, error=errors, seconds=seconds)

    return df.withColumn("_budget", token_budget(F.length(prompt))).mapInPandas(run, schema)


def batch_request(files: list[str], texts: list[str]) -> str:
    return "\n".join(f"FILE: {name}\n{text}" for name, text in zip(files, texts, strict=True))


def batch_parts(response: str) -> dict[str, str]:
    """What a batch's response says of each file: the lines below its "FILE: <name>" line, stripped; the first of a name counts."""
    found: dict[str, list[str]] = {}
    lines: list[str] | None = None
    for line in response.splitlines():
        if line.startswith("FILE: "):
            name = line[len("FILE: ") :].strip()
            lines = None if name in found else found.setdefault(name, [])
        elif lines is not None:
            lines.append(line)
    return {name: "\n".join(part).strip() for name, part in found.items()}


def forgetful_client(prompt: str, max_tokens: int) -> str:
    """A stand-in for a model that answers a batch: the length of each file's text, but nothing of a batch's last file, and an
    error for requests with an even number of files above two."""
    parts = batch_parts(prompt)
    names = list(parts)
    if len(names) > 2 and len(names) % 2 == 0:
        raise TimeoutError("too long")
    return "\n".join(f"FILE: {n}\n{len(parts[n])} characters" for n in (names if len(names) == 1 else names[:-1]))


def ask_batches(df: DataFrame, batch: str, file: str, text: str, client: Client, attempts: int = 3, pause_s: float = 0.0) -> DataFrame:
    """(batch, file, response, error, asked_alone) of df (batch, file, text): each batch, a few files by its meaning, is one request,
    in the order of its files. Files that its response lacks or leaves empty, and all of a batch whose request failed, are asked for
    one by one. A file without a response in the end has the last error. Null texts count as empty, null files are left out."""
    rows = df.where(F.col(file).isNotNull()).select(batch, file, F.coalesce(text, F.lit("")).alias(text))
    listed = F.array_sort(F.collect_list(F.struct(F.col(file).alias("file"), F.col(text).alias("text"))))
    request = F.array_join(F.transform("_files", lambda x: F.concat(F.lit("FILE: "), x["file"], F.lit("\n"), x["text"])), "\n")
    batches = rows.groupBy(batch).agg(listed.alias("_files")).withColumn("_prompt", request)
    kind = df.schema[batch].dataType.simpleString()

    def parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key, files, response in zip(frame[batch], frame["_files"], frame["response"], strict=True):
                found = batch_parts(response) if response else {}
                out += [(key, x["file"], found.get(x["file"]) or None, batch_request([x["file"]], [x["text"]])) for x in files]
            yield pd.DataFrame(out, columns=[batch, file, "_part", "_alone"])

    answered = ask(batches, "_prompt", client, attempts, pause_s).mapInPandas(parts, f"`{batch}` {kind}, `{file}` string, _part string, _alone string")
    answered = scratch.stored(answered, "answers")  # requests are not repeated
    found = answered.where("_part is not null").select(batch, file, F.col("_part").alias("response"), F.lit(None).cast("string").alias("error"), F.lit(False).alias("asked_alone"))

    def single(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            parts_of = [batch_parts(r).get(name) if r else None for r, name in zip(frame["response"], frame[file], strict=True)]
            lacks = [e if e else (None if p else "no part for the file") for e, p in zip(frame["error"], parts_of, strict=True)]
            yield frame[[batch, file]].assign(response=[p or None for p in parts_of], error=lacks, asked_alone=True)

    again = ask(answered.where("_part is null").select(batch, file, "_alone"), "_alone", client, attempts, pause_s)
    return found.unionByName(again.mapInPandas(single, f"`{batch}` {kind}, `{file}` string, response string, error string, asked_alone boolean"))


def spelt_back(line: str) -> str:
    """A stand-in translator: five vowels of one script for those of another."""
    return line.translate(str.maketrans("अएइओउ", "aeiou"))


def hashed_embedding(c: Column, size: int = EMBEDDING_SIZE) -> Column:
    """A bag-of-words vector by feature hashing: a deterministic stand-in for a sentence encoder."""

    @F.pandas_udf("array<float>")
    def embed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            out = []
            for text in batch:
                v = [0.0] * size
                for word in (text or "").lower().split():
                    h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
                    v[h % size] += 1.0 if h >> 63 else -1.0
                out.append(v)
            yield pd.Series(out)

    return embed(c)


def translate_lines(c: Column, translator: Callable[[str], str]) -> Column:
    """Each line that is mostly Devanagari through the translator, others with ASCII digits; a failing line stays."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        def line(x: str) -> str:
            share = sum("ऀ" <= ch <= "ॿ" for ch in x) / len(x) if x else 0
            if share < T.SCRIPT_RATIO:
                return x.translate(str.maketrans(T.DEVANAGARI_DIGITS, "0123456789"))
            try:
                return translator(x.translate(str.maketrans(T.DEVANAGARI_DIGITS, "0123456789")))
            except Exception:
                return x

        return texts.map(lambda t: None if t is None else "\n".join(line(x) for x in t.split("\n")))

    return run(c)


def not_available(what: str) -> Callable:
    """The default for pixel work (rendering, block detection, OCR): says what has to be plugged in."""

    def missing(*args, **kwargs):
        raise NotImplementedError(f"no {what} is configured; pass a function that does it")

    return missing


def over_bytes(df: DataFrame, content: str, function: Callable[[bytes], list[tuple]], schema: str) -> DataFrame:
    """A row for each result of function(content): pages of a PDF, blocks of an image, text of a block. Other columns
    pass through, and a file that fails gives one row with only its error."""
    kept = [f for f in df.schema if f.name != content]
    columns = [x.split()[0] for x in schema.split(", ")]
    full = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), schema, "error string"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for row in frame.to_dict("records"):
                head = [row[f.name] for f in kept]
                try:
                    rows += [[*head, *result, None] for result in function(row[content])]
                except Exception as e:
                    rows.append([*head, *[None] * len(columns), f"{type(e).__name__}: {e}"])
            yield pd.DataFrame(rows, columns=[*(f.name for f in kept), *columns, "error"])

    return df.mapInPandas(run, full)
