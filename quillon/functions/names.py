"""Normal forms and checks of names, expressions, conditions and report texts as Column expressions; all stay in the JVM.

Null in, null out; empty texts have the empty form unless a function says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quillon.functions.text import fold_case

#: Every character that counts as white space.
SPACES = "\\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Spellings of one quantity, as (found, meant).
VARIANTS = (("体积", "容积"), ("绝对数", "绝对值"), ("百分率", "百分数"), ("血红蛋白量", "血红蛋白含量"))
# Words that say the state of an indicator behind "为".
STATE_WORDS = ("阳性", "阴性", "正常", "异常", "增高", "降低", "不升高")
# Words with which the state part of a state name begins.
STATE_STARTS = ("正常", "异常", "升高", "降低", "增高", "减低", "增大", "减小", "减少", "增多", "阳性", "阴性", "延长", "缩短")
# Word operators of conditions.
OPERATORS = ("EQ", "NE", "GT", "GE", "LT", "LE", "BETWEEN", "IN", "POSITIVE", "NEGATIVE")
# Names that are no entity, and names and endings that are no method or drug.
GENERIC_NAMES, NO_METHODS, NO_METHOD_ENDS = ("疾病", "人"), ("形态学改变", "肌红蛋白", "运铁蛋白", "血常规检验"), ("检验", "检查", "改变")
# Character references that names carry.
_REFERENCES = (("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&times;", "×"), ("&micro;", "µ"), ("&deg;", "°"), ("&plusmn;", "±"), ("&le;", "≤"), ("&ge;", "≥"), ("&amp;", "&"))


def _replaced(text: Column, pairs) -> Column:
    for a, b in pairs:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def unescaped(text: Column) -> Column:
    """The usual character references as characters."""
    return F.when(text.contains("&"), _replaced(text, _REFERENCES)).otherwise(text)


def no_spaces(text: Column) -> Column:
    return F.regexp_replace(text, f"[{SPACES}]+", "")


def normal_name(name: Column) -> Column:
    """Case-folded, without formula marks, spaces and separating punctuation."""
    bare = F.regexp_replace(unescaped(name), r"\\\(|\\\)|\\mathrm|[{}$]", "")
    return F.replace(F.lower(F.regexp_replace(bare, f"[{SPACES}（）()·,:：，。]", "")), F.lit("ß"), F.lit("ss"))


def variant_key(name: Column) -> Column:
    """Folded, with one spelling for each of ``VARIANTS``, taken one after the other."""
    return _replaced(fold_case(name), VARIANTS)


def surface(mention: Column) -> Column:
    """Without spaces, and without the copula before a state."""
    return F.regexp_replace(no_spaces(mention), f"为(?=(?:{'|'.join(STATE_WORDS)}))", "")


def state_base(state: Column, starts: tuple[str, ...] = STATE_STARTS) -> Column:
    """A state name up to its state; the whole name where it says none."""
    return F.regexp_replace(state, f"(?s)(?:{'|'.join(starts)}).*$", "")


def endpoint_text(name: Column) -> Column:
    """Letters and digits only, case-folded."""
    return F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]+", "")


def condition_error(condition: Column) -> Column:
    """``invalid_condition`` (null or empty), ``unsupported_operator`` (a sign), ``missing_operator`` (no word), else null."""
    return (
        F.when(condition.isNull() | (condition == ""), "invalid_condition")
        .when(condition.rlike("==|!=|>=|<=|(?:^|[^A-Za-z])=|>|<"), "unsupported_operator")
        .when(~condition.rlike(rf"\b(?:{'|'.join(OPERATORS)})\b"), "missing_operator")
    )


def parsed_expression(expression: Column) -> Column:
    """``output, name, inputs, error`` of ``output = name(input, input)``; inputs are distinct and at least one."""
    shape = r"^\s*([^=()]+?)\s*=\s*([^=()]+?)\(([^()]*)\)\s*$"
    fits = F.coalesce(expression.rlike(shape), F.lit(False))
    part = lambda n: F.when(fits, F.trim(F.regexp_extract(expression, shape, n)))
    inputs = F.filter(F.transform(F.split(F.regexp_extract(expression, shape, 3), "[,，]"), lambda x: F.trim(x)), lambda x: x != "")
    error = F.when(~fits, "invalid_rule_expression").when(F.size(inputs) == 0, "missing_inputs").when(F.size(F.array_distinct(inputs)) < F.size(inputs), "duplicate_inputs")
    return F.struct(part(1).alias("output"), part(2).alias("name"), F.when(fits, inputs).alias("inputs"), error.alias("error"))


def result_linked(result: Column, evidence: Column, text: Column) -> Column:
    """Whether a result stands in its evidence or in the short heading on the line right before the evidence in ``text``."""
    at = F.instr(text, evidence)
    before = F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise("")
    line = F.trim(F.element_at(F.split(F.regexp_replace(before, rf"[{SPACES}]+$", ""), "\n"), -1))
    heading = F.regexp_replace(line, r"^(?:\(?\d+\)?[、.)]?|[一二三四五六七八九十]+[、.])\s*", "")
    above = before.rlike(r"\n[ \t]*$") & F.length(line).between(1, 80) & ~F.substring(line, -1, 1).isin(*"。！？；.!?;") & F.contains(heading, result)
    return F.contains(evidence, result) | F.coalesce(above, F.lit(False))


def layout_text(text: Column) -> Column:
    """Text of a layout cell without formula markup and blanks."""
    t = _replaced(F.replace(text, F.lit("$"), F.lit("")), ((r"\mu", "μ"), (r"\gamma", "γ"), (r"\alpha", "α"), (r"\beta", "β")))
    for pattern, by in ((r"\\(?:text|mathrm|mathbf|operatorname)\{([^{}]*)\}", "$1"), (r"_\{([^{}]+)\}", "$1"), (r"\^\{([+-]?\d+)\}", "^$1"), (r"\^\{\{([*★])\}\}", "$1")):
        t = F.regexp_replace(t, pattern, by)
    return no_spaces(F.replace(t, F.lit(r"\cdot"), F.lit("*")))


def layout_unit(text: Column) -> Column:
    """The unit that a cell holds: of unit characters, at most 40, without an operator left open; else null."""
    unit = layout_text(text)
    return F.when((unit != "") & (F.upper(unit) != "NULL") & ~unit.rlike(r"[/*^+\-]$") & unit.rlike(r"^[A-Za-zμ%0-9/().*^+\-²³]{1,40}$"), unit)


def report_metadata(text: Column) -> Column:
    """``hospital, report_date, patient_sex, patient_age_years, sample_type, department`` of a report's lines; null where not stated."""
    found = lambda pattern, n=1: F.nullif(F.regexp_extract(text, pattern, n), F.lit(""))
    line = F.try_element_at(F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x.contains("医院") & (F.length(x) <= 100)), F.lit(1))
    short = F.trim(F.regexp_replace(line, r"\s*(?:临床)?检验(?:结果)?报告单.*$", ""))
    day = r"(20\d{2})[年./-](\d{1,2})[月./-](\d{1,2})日?"
    date = F.try_to_date(F.concat_ws("-", found(day), F.lpad(found(day, 2), 2, "0"), F.lpad(found(day, 3), 2, "0")), "yyyy-MM-dd")
    age = found(r"年龄\s*[:：]?\s*(\d{1,3})").cast("int")
    return F.struct(
        F.coalesce(F.nullif(short, F.lit("")), line).alias("hospital"), date.alias("report_date"), found(r"性别\s*[:：]?\s*(男|女)").alias("patient_sex"), F.when(age.between(1, 129), age).alias("patient_age_years"),
        found(r"(?:样本类型|标本类型|标本种类)\s*[:：]?\s*([^\s,，;；]{1,20})").alias("sample_type"), found(r"(?:科别|科室)\s*[:：]?\s*([^\s,，;；<]{1,30})").alias("department"),
    )


def category_error(category: Column, key: Column) -> Column:
    """Why a name (as match key) is no entity of its category, else null."""
    no_method = key.isin(*NO_METHODS) | key.rlike(f"(?:{'|'.join(NO_METHOD_ENDS)})$")
    return F.when(key.isin(*GENERIC_NAMES), "generic term is not an entity").when((category == "MethodOrDrug") & no_method, "not a method, specimen, device, operation, or drug")
