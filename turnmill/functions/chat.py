"""Rendering of message arrays as text.

A sample with a NULL role or content renders as NULL: Spark's ``array_join`` would
silently leave the turn out.
"""

from pyspark.sql import Column, functions as F

from turnmill.config import PLAIN, ChatTemplate
from turnmill.functions.text import cut

# Texts that result files of both implementations share.
NO_PROMPT_ERROR = "Sample must have 'messages' or 'prompt' field"
NO_MESSAGE_ERROR = "list index out of range"


def _if_whole(messages: Column, text: Column) -> Column:
    return F.when(~F.exists(messages, lambda m: m["role"].isNull() | m["content"].isNull()), text)


def concat_messages(messages: Column) -> Column:
    """All contents, joined by one space."""
    return _if_whole(messages, F.array_join(messages["content"], " "))


def capitalize(col: Column) -> Column:
    """First letter upper, all others lower (``initcap`` would treat every word)."""
    return F.concat(F.upper(F.left(col, F.lit(1))), F.lower(F.substring(col, 2, 2147483647)))


def render_chat(messages: Column, template: ChatTemplate = PLAIN, add_generation_prompt: bool = False) -> Column:
    """Render a message array with ``template``."""

    def turn(m: Column) -> Column:
        role = capitalize(m["role"]) if template.capitalize_roles else m["role"]
        return F.concat(
            F.lit(template.role_prefix),
            role,
            F.lit(template.role_suffix),
            m["content"],
            F.lit(template.turn_end),
        )

    text = _if_whole(messages, F.array_join(F.transform(messages, turn), template.separator))
    tail = template.generation_prefix if add_generation_prompt else ""
    if template.bos or tail:
        text = F.concat(F.lit(template.bos), text, F.lit(tail))
    return text


def model_prompt(messages: Column, prompt: Column, template: ChatTemplate | None = None) -> Column:
    """The text a model is given: the rendered messages if there are any, else ``prompt``."""
    if template is None:
        rendered = F.concat(render_chat(messages), F.lit("\nAssistant:"))
    else:
        rendered = render_chat(messages, template, add_generation_prompt=True)
    return F.when(messages.isNotNull(), rendered).otherwise(prompt)


def prompt_error(messages: Column, prompt: Column) -> Column:
    """Why there is nothing to give a model; NULL when there is."""
    return F.when(messages.isNull() & prompt.isNull(), F.lit(NO_PROMPT_ERROR))


def record_error(messages: Column, prompt: Column) -> Column:
    """Why an answered sample has no prompt to show: an empty message list and no prompt."""
    no_prompt = F.coalesce(prompt, F.lit("")) == ""
    return F.when((F.array_size(messages) == 0) & no_prompt, F.lit(NO_MESSAGE_ERROR))


def shown_prompt(messages: Column, prompt: Column) -> Column:
    """The prompt a result record shows: ``prompt`` if not empty, else the last content."""
    last = F.try_element_at(messages, F.lit(-1))["content"]
    return F.coalesce(F.nullif(prompt, F.lit("")), last, F.lit(""))


def message_preview(content: Column, width: int = 200) -> Column:
    """Content cut for a preview listing."""
    return cut(content, width)


def lead_in(col: Column, width: int) -> Column:
    """The first ``width`` characters and always '...'."""
    return F.concat(F.left(col, F.lit(width)), F.lit("..."))
