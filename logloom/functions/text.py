"""Text columns: normalisation, tokens, templates, previews."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = r"^[\s\p{Z}]*$"


def is_blank(x: Column) -> Column:
    return x.rlike(BLANK)


def strip(x: Column) -> Column:
    """Remove white space (not only spaces) on both sides."""
    return F.regexp_replace(x, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def normalize_text(x: Column) -> Column:
    """Lower case, punctuation except ``'`` to spaces, single spaces, trimmed.

    Letters and digits of every script stay; Java's ``\\w`` would drop accents.
    """
    spaced = F.regexp_replace(F.lower(x), r"[^\p{L}\p{N}_\s']", " ")
    return F.trim(F.regexp_replace(spaced, r"\s+", " "))


def tokens(x: Column) -> Column:
    """White-space tokens without empty strings."""
    return F.filter(F.split(x, r"\s+"), lambda t: t != "")


def token_count(x: Column) -> Column:
    return F.size(tokens(x))


def truncate_tokens(x: Column, max_tokens: int) -> Column:
    """The first ``max_tokens`` word tokens, joined by one space."""
    return F.array_join(F.slice(tokens(x), 1, max_tokens), " ")


def preview(x: Column, width: int = 100) -> Column:
    return F.concat(F.left(x, F.lit(width)), F.lit("..."))


def strip_prompt(output: Column, prompt: Column) -> Column:
    """Drop a leading copy of the prompt from generated text and trim the rest."""
    tail = F.substr(output, F.length(prompt) + 1)
    return strip(F.when(F.startswith(output, prompt), tail).otherwise(output))


def join_paragraphs(paragraphs: Column, separator: str = "\n\n") -> Column:
    return F.array_join(paragraphs, separator)


# Fixed value: the instruction prompt.
INSTRUCTION_TEMPLATE = "### Instruction:\n{instruction}\n\n### Input:\n{input}\n\n### Response:\n{output}"


def render_template(template: str = INSTRUCTION_TEMPLATE, **slots: Column) -> Column:
    """Fill ``{name}`` slots with columns; a null column or missing slot prints nothing."""
    parts = []
    for text, name, _, _ in string.Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if name is not None:
            value = slots.get(name)
            parts.append(F.lit("") if value is None else F.coalesce(value.cast("string"), F.lit("")))
    return F.concat(*parts)
