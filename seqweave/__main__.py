"""Command line: ``python -m seqweave -i IN -o OUT [-m 8192] [-f arrow]`` (or spark-submit).

Options mirror the reference's program: input file or folder, output folder,
tokenizer, max length and format.  Chat template and special tokens are
parameters here (``--template sections|headers``, ``--bos``, ``--eos``)
instead of being fetched from a model hub.
"""

from __future__ import annotations

import argparse
import json
from dataclasses import replace

from seqweave.functions.config import read_tokenizer_config
from seqweave.functions.template import ChatTemplate
from seqweave.functions.tokenizers import CodePointTokenizer, PretrainedTokenizer
from seqweave.plans.job import pack_job
from seqweave.session import get_session


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="seqweave",
                                description="Pack a folder of JSONL conversations into training bins")
    p.add_argument("-i", "--input", required=True, help="a JSONL file or a folder of *.jsonl files")
    p.add_argument("-o", "--output", required=True, help="output folder")
    p.add_argument("-t", "--tokenizer", default="codepoint",
                   help="'codepoint' or a path to a tokenizer.json file")
    p.add_argument("-m", "--max-length", type=int, default=8192)
    p.add_argument("-f", "--format", default="arrow", help="arrow | jsonl | parquet")
    p.add_argument("--template", default=None,
                   help="'sections' (default without --config), 'headers' or a rules file (*.json)")
    p.add_argument("--config", default=None,
                   help="local tokenizer_config.json providing bos_token and eos_token; its template text is "
                        "not interpreted, so --template must be given with it")
    p.add_argument("--bos", default=None)
    p.add_argument("--eos", default=None)
    p.add_argument("--tail", default="keep", choices=["keep", "drop"])
    p.add_argument("--on-error", default="fail", choices=["fail", "quarantine"])
    p.add_argument("--layout", default="parts", choices=["parts", "file"])
    p.add_argument("--generation-prompt", action="store_true",
                   help="append the template's generation prompt (off in the reference pipeline)")
    p.add_argument("--master", default=None, help="only for local runs; spark-submit sets it")
    return p


def build_template(args) -> ChatTemplate:
    if args.config:
        if not args.template:
            raise ValueError("--config holds a chat_template that is not interpreted: name one with --template")
        cfg = read_tokenizer_config(args.config)
        args.bos = args.bos if args.bos is not None else cfg.bos_token
        args.eos = args.eos if args.eos is not None else cfg.eos_token
    tokens = {k: v for k, v in (("bos_token", args.bos), ("eos_token", args.eos)) if v is not None}
    name = args.template or "sections"
    if name in ("sections", "headers"):
        return getattr(ChatTemplate, name)(**tokens)
    if not name.endswith(".json"):
        raise ValueError(f"unknown template: {name}")
    with open(name, encoding="utf-8") as fh:
        return replace(ChatTemplate.from_rules(json.load(fh)), **tokens)


def main(argv=None) -> None:
    args = build_parser().parse_args(argv)
    template = build_template(args)
    spark = get_session(args.master)
    tokenizer = CodePointTokenizer() if args.tokenizer == "codepoint" else PretrainedTokenizer(args.tokenizer)
    res = pack_job(spark, args.input, args.output, template, tokenizer, args.max_length,
                   args.format, args.tail, args.on_error, layout=args.layout,
                   add_generation_prompt=args.generation_prompt)
    # one line per input file, streamed partition by partition (not collected)
    for row in res["report"].toLocalIterator():
        print(json.dumps(row.asDict()))


if __name__ == "__main__":
    main()
