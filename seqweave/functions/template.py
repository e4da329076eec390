"""Chat templates compiled to one Spark Column (no template interpreter).

A template is declared as data: an optional preamble, an optional system
block that lifts a leading system message out of the list, one rule per role
and an optional generation prompt.  ``ChatTemplate.render`` turns that into a
single expression over an ``array<struct<role, content>>`` column built from
``transform``/``array_join``/``concat``: rendering is a built-in expression
evaluated in the JVM, with no Python and no template interpreter.

Two presets reproduce the templates used by the reference tests:
``ChatTemplate.sections()`` ("### User:" style) and ``ChatTemplate.headers()``
(header-id style with a system block).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode-aware strip of leading and trailing whitespace (newlines included);
# Spark's own trim() only removes spaces.
_TRIM_PATTERN = r"(?U)\A\s+|\s+\z"

_ROLE = "{role}"


def trim_unicode(c: Column) -> Column:
    """Strip all leading/trailing Unicode whitespace, like a template ``trim``."""
    return F.regexp_replace(c, _TRIM_PATTERN, "")


def json_quote(c: Column) -> Column:
    """JSON-encode one string the way a template ``tojson`` filter does.

    ``to_json`` only takes containers, so the string is wrapped in an array
    and the brackets are cut off; HTML-sensitive characters are escaped as
    ``\\u00XX`` like the template engine's filter.
    """
    quoted = F.to_json(F.array(c))
    body = F.regexp_replace(quoted, r"\A\[|\]\z", "")
    for ch, esc in (("&", "\\\\u0026"), ("'", "\\\\u0027"), ("<", "\\\\u003c"), (">", "\\\\u003e")):
        body = F.regexp_replace(body, ch, esc)
    return body


@dataclass(frozen=True)
class RoleRule:
    """How one message of a role is rendered.

    ``prefix``/``suffix`` may contain ``{role}``, replaced by the message's role.
    """

    prefix: str = ""
    suffix: str = ""
    trim: bool = False
    skip_empty: bool = False
    json_content: bool = False

    def render(self, m: Column) -> Column:
        content = m["content"]
        if self.json_content:
            content = json_quote(content)
        elif self.trim:
            content = trim_unicode(content)
        text = F.concat(*_with_role(self.prefix, m), content, *_with_role(self.suffix, m))
        if self.skip_empty:
            text = F.when(F.length(m["content"]) > 0, text).otherwise(F.lit(""))
        return text


def _with_role(text: str, m: Column) -> list[Column]:
    if not text:
        return []
    pieces = text.split(_ROLE)
    out: list[Column] = []
    for i, piece in enumerate(pieces):
        if i:
            out.append(m["role"])
        if piece:
            out.append(F.lit(piece))
    return out


@dataclass(frozen=True)
class SystemBlock:
    """Always-present system block; a leading system message fills it."""

    prefix: str
    suffix: str
    trim: bool = True


@dataclass(frozen=True)
class ChatTemplate:
    rules: tuple[tuple[str, RoleRule], ...]
    default: RoleRule | None = None
    bos_token: str | None = None
    eos_token: str | None = None
    preamble: str = ""
    system_block: SystemBlock | None = None
    generation_prompt: str = ""
    generation_prompt_needs_messages: bool = False
    name: str = field(default="custom", compare=False)

    # ------------------------------------------------------------------ presets
    @staticmethod
    def sections(bos_token: str | None = None, eos_token: str | None = None) -> ChatTemplate:
        """System / User / Assistant sections; unknown roles render nothing."""
        # Fixed values of the "sections" template (must match the reference test).
        system = RoleRule(prefix="### System:\n", suffix="\n\n", skip_empty=True)
        user = RoleRule(prefix="### User:\n", suffix="\n\n")
        assistant = RoleRule(prefix="### Assistant:\n")
        generation = "### Assistant:\n"
        return ChatTemplate(
            rules=(("system", system), ("user", user), ("assistant", assistant)),
            default=None,
            bos_token=bos_token,
            eos_token=eos_token,
            generation_prompt=generation,
            generation_prompt_needs_messages=True,
            name="sections",
        )

    @staticmethod
    def headers(bos_token: str = "<|begin_of_text|>", eos_token: str = "<|eot_id|>",
                date_string: str = "26 Jul 2024") -> ChatTemplate:
        """Header-id template with an always-present system block."""
        # Fixed values of the "headers" template (must match the reference test).
        start, end, eot = "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>"
        knowledge = "Cutting Knowledge Date: December 2023\n"
        today = "Today Date: " + date_string + "\n\n"
        tool = RoleRule(prefix=start + "ipython" + end + "\n\n", suffix=eot, json_content=True)
        return ChatTemplate(
            rules=(("tool", tool), ("ipython", tool)),
            default=RoleRule(prefix=start + _ROLE + end + "\n\n", suffix=eot, trim=True),
            bos_token=bos_token,
            eos_token=eos_token,
            preamble="{bos_token}",
            system_block=SystemBlock(prefix=start + "system" + end + "\n\n" + knowledge + today,
                                     suffix=eot),
            generation_prompt=start + "assistant" + end + "\n\n",
            generation_prompt_needs_messages=False,
            name="headers",
        )

    @staticmethod
    def from_rules(raw: dict) -> ChatTemplate:
        """Template from a rules document (the fields of this class; see README).

        ``roles`` maps a role to a rule, ``default`` is the rule of other
        roles (absent: they render nothing); unknown keys are refused.
        """
        raw = dict(raw)
        roles = raw.pop("roles", {})
        default, block = raw.pop("default", None), raw.pop("system_block", None)
        return ChatTemplate(
            rules=tuple((role, RoleRule(**rule)) for role, rule in roles.items()),
            default=RoleRule(**default) if default is not None else None,
            system_block=SystemBlock(**block) if block is not None else None, **raw)

    # ------------------------------------------------------------------ compile
    def _text(self, s: str) -> str:
        return s.replace("{bos_token}", self.bos_token or "").replace("{eos_token}", self.eos_token or "")

    def _rule(self, rule: RoleRule) -> RoleRule:
        return replace(rule, prefix=self._text(rule.prefix), suffix=self._text(rule.suffix))

    def _message(self, m: Column) -> Column:
        expr = None
        for role, rule in self.rules:
            cond = m["role"] == F.lit(role)
            text = self._rule(rule).render(m)
            expr = F.when(cond, text) if expr is None else expr.when(cond, text)
        fallback = self._rule(self.default).render(m) if self.default is not None else F.lit("")
        return fallback if expr is None else expr.otherwise(fallback)

    def render(self, messages: Column | str, add_generation_prompt: bool = False) -> Column:
        """Compile the template over an ``array<struct<role,content>>`` column."""
        msgs = F.col(messages) if isinstance(messages, str) else messages
        parts: list[Column] = []
        if self.preamble:
            parts.append(F.lit(self._text(self.preamble)))
        body = msgs
        if self.system_block is not None:
            first = F.get(msgs, 0)
            is_system = F.coalesce(first["role"] == F.lit("system"), F.lit(False))
            content = trim_unicode(first["content"]) if self.system_block.trim else first["content"]
            parts.append(F.lit(self._text(self.system_block.prefix)))
            parts.append(F.when(is_system, content).otherwise(F.lit("")))
            parts.append(F.lit(self._text(self.system_block.suffix)))
            rest = F.slice(msgs, 2, F.greatest(F.size(msgs) - 1, F.lit(0)))
            body = F.when(is_system, rest).otherwise(msgs)
        parts.append(F.array_join(F.transform(body, self._message), ""))
        if add_generation_prompt and self.generation_prompt:
            gen = F.lit(self._text(self.generation_prompt))
            if self.generation_prompt_needs_messages:
                gen = F.when(F.size(msgs) > 0, gen).otherwise(F.lit(""))
            parts.append(gen)
        return F.concat(*parts)
