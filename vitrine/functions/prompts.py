"""Prompt and query texts. The whitespace of each format is data (see ``fixed``)."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from vitrine.functions import fixed
from vitrine.functions.text import WS, strip_ws


def render(template: str, **fields: Column) -> Column:
    """Fill ``{field}`` places of a template; a NULL field renders as ''."""
    parts = []
    for piece in re.split(r"(\{\w+\})", template):
        if re.fullmatch(r"\{\w+\}", piece):
            parts.append(F.coalesce(fields[piece[1:-1]], F.lit("")))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


def training_prompt(name: Column, color: Column, description: Column) -> Column:
    return render(fixed.TRAINING_PROMPT, name=name, color=color, description=description)


def product_text(name: Column, color: Column, description: Column) -> Column:
    return render(fixed.PRODUCT_TEXT, name=name, color=color, description=description)


def query_text(name: Column, color: Column) -> Column:
    given = F.coalesce(color, F.lit("")) != ""
    return F.when(given, render(fixed.QUERY_TEXT_COLOR, name=name, color=color)).otherwise(
        render(fixed.QUERY_TEXT_PLAIN, name=name)
    )


def inference_prompt(name: Column, color: Column) -> Column:
    return render(fixed.INFERENCE_PROMPT, name=name, color=color)


def fewshot_prompt(name: Column, color: Column, examples: Column) -> Column:
    """Prompt led by retrieved examples.

    ``examples`` is an array of ``struct<rank, name_clean, colors_extracted,
    fulldescription_clean>`` ordered by rank. Without examples this is the plain inference prompt.
    """

    def block(example: Column, position: Column) -> Column:
        colors = F.coalesce(example["colors_extracted"], F.lit(""))
        return F.concat(
            F.concat(F.lit("Example "), (position + 1).cast("string"), F.lit(":\n")),
            render("Product: {name}\n", name=example["name_clean"]),
            F.when(colors != "", render("    Color: {c}\n", c=colors)).otherwise(F.lit("")),
            render("    Description: {d}\n", d=example["fulldescription_clean"]),
        )

    context = F.concat_ws(
        "\n",
        F.lit(fixed.FEWSHOT_HEADER),
        F.array_join(F.transform(examples, block), "\n"),
        F.lit(fixed.FEWSHOT_RULE),
        F.lit(fixed.FEWSHOT_ASK),
        F.lit(""),
    )
    has_examples = F.coalesce(F.size(examples), F.lit(0)) > 0
    return F.concat(
        F.when(has_examples, context).otherwise(F.lit("")), inference_prompt(name, color)
    )


def split_prompt(prompt: Column, marker: str | None = None) -> tuple[Column, Column]:
    """Split at the first marker into (input including the marker, stripped reference).

    Without a literal ``marker``, the marker is ``Description:`` and one following whitespace
    character, so that both ``Description: text`` and ``Description:\\ntext`` split. A prompt without
    marker is all input and has an empty reference.
    """
    if marker is None:
        found = F.regexp_instr(prompt, F.lit(fixed.DESCRIPTION_MARKER + WS))
        length = len(fixed.DESCRIPTION_MARKER) + 1
    else:
        found = F.instr(prompt, marker)
        length = len(marker)
    cut = found + length - 1
    text_in = F.when(found > 0, F.substring(prompt, F.lit(1), cut)).otherwise(prompt)
    reference = F.when(
        found > 0, strip_ws(F.substring(prompt, cut + 1, F.length(prompt)))
    ).otherwise(F.lit(""))
    return text_in, reference


def strip_prefix(text: Column, prefix: Column, always: bool = False) -> Column:
    """Text after ``prefix``, stripped.

    By default only a real prefix is cut; ``always=True`` cuts as many characters as the prefix has.
    """
    rest = F.substring(text, F.length(prefix) + 1, F.length(text))
    return strip_ws(rest if always else F.when(F.startswith(text, prefix), rest).otherwise(text))

