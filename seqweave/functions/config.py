"""Tokenizer configuration from a local ``tokenizer_config.json``.

The reference fetches the config from a model hub and requires three strings:
``bos_token``, ``eos_token`` and ``chat_template``.  Here the file is local
(no network); bos/eos feed a template preset, and the Jinja text itself is
kept for reference only, because templates are declared as
``ChatTemplate`` data rather than interpreted.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

REQUIRED = ("bos_token", "eos_token", "chat_template")


@dataclass(frozen=True)
class TokenizerConfig:
    bos_token: str
    eos_token: str
    chat_template: str


def _token(value):
    # special tokens are either plain strings or {"content": "..."} objects
    if isinstance(value, dict):
        value = value.get("content")
    return value


def read_tokenizer_config(path: str) -> TokenizerConfig:
    with open(path, encoding="utf-8") as fh:
        raw = json.load(fh)
    values = {k: _token(raw.get(k)) for k in REQUIRED}
    missing = [k for k, v in values.items() if not isinstance(v, str)]
    if missing:
        raise ValueError(f"{path}: missing or non-string {', '.join(missing)}")
    return TokenizerConfig(**values)
