"""The command line mirrors the reference program's options."""

import glob
import json
import os

import pytest

from seqweave.__main__ import build_parser, main


def test_parser_defaults():
    args = build_parser().parse_args(["-i", "in", "-o", "out"])
    assert (args.max_length, args.format, args.tokenizer, args.template) == (8192, "arrow", "codepoint", None)


def test_cli_runs_a_jsonl_job(spark, tmp_dir, capsys):
    src = f"{tmp_dir}/in"
    os.makedirs(src)
    with open(f"{src}/a.jsonl", "w", encoding="utf-8") as fh:
        for c in ("hello there", "x"):
            fh.write(json.dumps({"conversation": [{"role": "user", "content": c}]}) + "\n")
    main(["-i", src, "-o", f"{tmp_dir}/out", "-m", "64", "-f", "JSONL", "--template", "headers"])
    report = [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
    assert report and report[0]["rows"] == 2 and report[0]["bins"] == 2
    rows = [json.loads(line) for f in glob.glob(f"{tmp_dir}/out/a/*.jsonl") for line in open(f)]
    head = ("<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\nCutting Knowledge Date: "
            "December 2023\nToday Date: 26 Jul 2024\n\n<|eot_id|><|start_header_id|>user<|end_header_id|>\n\n")
    expect = sorted(len(head) + len(c) + len("<|eot_id|>") for c in ("hello there", "x"))
    assert sorted(r["length"] for r in rows) == expect  # both over 64: one whole row per bin
    assert report[0]["input_tokens"] == sum(expect)


def test_cli_rejects_unknown_format(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    with pytest.raises(ValueError):
        main(["-i", f"{tmp_dir}/in", "-o", f"{tmp_dir}/out", "-f", "msgpack"])


def test_tokenizer_config(tmp_dir):
    from seqweave.functions.config import read_tokenizer_config

    path = f"{tmp_dir}/tokenizer_config.json"
    with open(path, "w", encoding="utf-8") as fh:
        json.dump({"bos_token": "[BOS]", "eos_token": {"content": "[EOS]"}, "chat_template": "Test template"}, fh)
    cfg = read_tokenizer_config(path)
    assert (cfg.bos_token, cfg.eos_token, cfg.chat_template) == ("[BOS]", "[EOS]", "Test template")
    with open(path, "w", encoding="utf-8") as fh:
        json.dump({"bos_token": "[BOS]"}, fh)
    with pytest.raises(ValueError, match="eos_token, chat_template"):
        read_tokenizer_config(path)


def test_config_needs_a_named_template_and_rules_files_work(spark, tmp_dir):
    from seqweave.__main__ import build_template

    config, rules = f"{tmp_dir}/tokenizer_config.json", f"{tmp_dir}/rules.json"
    with open(config, "w", encoding="utf-8") as fh:
        json.dump({"bos_token": "<s>", "eos_token": "</s>", "chat_template": "any text"}, fh)
    with open(rules, "w", encoding="utf-8") as fh:
        json.dump({"preamble": "{bos_token}", "roles": {"user": {"prefix": "U:", "suffix": "{eos_token}"}},
                   "default": {"prefix": "{role}:", "trim": True}, "generation_prompt": "A:"}, fh)

    def template(*args):
        return build_template(build_parser().parse_args(["-i", "in", "-o", "out", *args]))

    with pytest.raises(ValueError, match="--template"):
        template("--config", config)
    with pytest.raises(ValueError, match="unknown template"):
        template("--template", "other")
    assert template("--config", config, "--template", "headers").eos_token == "</s>"
    t = template("--config", config, "--template", rules)
    df = spark.createDataFrame([([("user", " x "), ("bot", " y ")],)], "messages array<struct<role:string,content:string>>")
    assert df.select(t.render("messages", True)).first()[0] == "<s>U: x </s>bot:yA:"
    with pytest.raises(TypeError):
        type(t).from_rules({"chat_template": "x"})
