"""Chat template presets against the reference's expected strings (FIXTURES §5-6)."""


from seqweave.functions.template import ChatTemplate, RoleRule

MSG = "array<struct<role:string,content:string>>"


def render(spark, messages, template, gen=False):
    df = spark.createDataFrame([(messages,)], f"m {MSG}")
    return df.select(template.render("m", gen).alias("p")).first()["p"]


SECTIONS_MSGS = [("user", "Hi!"), ("assistant", "Hello how can I help?"),
                 ("user", "What is Deep Learning?"), ("assistant", "magic!")]
SECTIONS_OFF = ("### User:\nHi!\n\n### Assistant:\nHello how can I help?### User:\n"
                "What is Deep Learning?\n\n### Assistant:\nmagic!")


def test_sections_generation_prompt_on(spark):
    out = render(spark, SECTIONS_MSGS, ChatTemplate.sections("[BOS]", "[EOS]"), gen=True)
    assert out == SECTIONS_OFF + "### Assistant:\n"


def test_sections_generation_prompt_off(spark):
    assert render(spark, SECTIONS_MSGS, ChatTemplate.sections("[BOS]", "[EOS]")) == SECTIONS_OFF


def test_sections_system_and_unknown_roles(spark):
    msgs = [("system", ""), ("system", "S"), ("tool", "x"), ("user", "u")]
    out = render(spark, msgs, ChatTemplate.sections())
    assert out == "### System:\nS\n\n### User:\nu\n\n"


def test_sections_empty_conversation_has_no_generation_prompt(spark):
    assert render(spark, [], ChatTemplate.sections(), gen=True) == ""


HEADERS_EXPECTED = (
    "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\n"
    "Cutting Knowledge Date: December 2023\nToday Date: 26 Jul 2024\n\n<|eot_id|>"
    "<|start_header_id|>user<|end_header_id|>\n\nWhat is the capital of Singapore?<|eot_id|>"
    "<|start_header_id|>assistant<|end_header_id|>\n\nI don't know, what is it?<|eot_id|>"
)


def test_headers_reference_string(spark):
    msgs = [("user", "What is the capital of Singapore?"), ("assistant", "I don't know, what is it?")]
    assert render(spark, msgs, ChatTemplate.headers()) == HEADERS_EXPECTED


def test_headers_system_split_and_unicode_trim(spark):
    msgs = [("system", " S\n"), ("user", "x\n   ")]
    out = render(spark, msgs, ChatTemplate.headers())
    assert "26 Jul 2024\n\nS<|eot_id|>" in out
    assert out.endswith("<|start_header_id|>user<|end_header_id|>\n\nx<|eot_id|>")
    assert out.count("system<|end_header_id|>") == 1


def test_headers_generation_prompt_and_tool_role(spark):
    msgs = [("user", "q"), ("tool", 'say "<hi>" & \'bye\'')]
    out = render(spark, msgs, ChatTemplate.headers(), gen=True)
    assert '<|start_header_id|>ipython<|end_header_id|>\n\n"say \\"\\u003chi\\u003e\\" \\u0026 \\u0027bye\\u0027"<|eot_id|>' in out
    assert out.endswith("<|start_header_id|>assistant<|end_header_id|>\n\n")


def test_headers_empty_conversation(spark):
    out = render(spark, [], ChatTemplate.headers())
    assert out.endswith("Today Date: 26 Jul 2024\n\n<|eot_id|>")


def test_custom_rule_with_role_placeholder(spark):
    t = ChatTemplate(rules=(), default=RoleRule(prefix="[{role}] ", suffix="|"), preamble="{bos_token}",
                     bos_token="<s>")
    assert render(spark, [("a", "1"), ("b", "2")], t) == "<s>[a] 1|[b] 2|"


def test_config_tokens_reach_template():
    t = ChatTemplate.sections("[BOS]", "[EOS]")
    assert (t.bos_token, t.eos_token) == ("[BOS]", "[EOS]")


def test_render_is_a_jvm_expression(spark):
    df = spark.createDataFrame([(SECTIONS_MSGS,)], f"m {MSG}")
    plan = df.select(ChatTemplate.sections().render("m").alias("p"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_special_tokens_in_role_rules(spark):
    t = ChatTemplate(rules=(("assistant", RoleRule(prefix="A: ", suffix="{eos_token}")),),
                     default=RoleRule(prefix="{bos_token}U: "), bos_token="<s>", eos_token="</s>")
    assert render(spark, [("user", "q"), ("assistant", "a")], t) == "<s>U: qA: a</s>"


def test_headers_late_system_message_is_an_ordinary_block(spark):
    out = render(spark, [("user", "u"), ("system", " s ")], ChatTemplate.headers())
    assert "Today Date: 26 Jul 2024\n\n<|eot_id|>" in out  # empty system block
    assert out.endswith("<|start_header_id|>system<|end_header_id|>\n\ns<|eot_id|>")


def test_sections_empty_user_and_assistant_content_still_render(spark):
    out = render(spark, [("user", ""), ("assistant", "")], ChatTemplate.sections())
    assert out == "### User:\n\n\n### Assistant:\n"
