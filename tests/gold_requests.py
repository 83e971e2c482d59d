"""Requests built from the grammar, with company and code worked out by hand from its rules."""

OPENINGS = ["请帮我分析一下", "分析一下", "分析", "我想了解一下", "帮我看看", ""]
NAMES = ["远山重工", "青禾食品"]
CODES = ["61234", "601234"]
BRACKETS = [("(", ")"), ("（", "）"), ("(", "）")]

#: Name, then its code in brackets of either width, after every opening.
NAMED = [
    (f"{opening}{name}{left}{code}{right}", name, code)
    for opening in OPENINGS
    for name, code in zip(NAMES, CODES)
    for left, right in BRACKETS
]
#: The code first, where an opening allows it.
CODE_FIRST = [(f"分析({code}){name}", name, code) for name, code in zip(NAMES, CODES)] + [
    (f"帮我看看（{code}）{name}这只股票", name, code) for name, code in zip(NAMES, CODES)
]
#: Codes of four or seven digits are none; the name is found without them.
BAD_CODES = [(f"分析蓝湾物流({code})", "蓝湾物流", None) for code in ("6123", "6012345")]
ALONE = [
    ("601234", None, "601234"),
    ("看 601234 如何", None, "601234"),
    ("601234这只股票值得买吗", None, "601234"),  # digits beside CJK are no word of their own
    ("601234走势", None, None),
    ("蓝湾物流的估值怎么样", "蓝湾物流", None),
    ("蓝湾物流面临哪些问题", "蓝湾物流", None),
    ("了解一下蓝湾物流", "蓝湾物流", None),
    ("分析一下蓝湾物流的现金流状况", "蓝湾物流", None),
    ("分析一下甲", None, None),  # one character is no name
    ("分析", None, None),
    ("", None, None),
    ("   ", None, None),
]
CASES = NAMED + CODE_FIRST + BAD_CODES + ALONE
