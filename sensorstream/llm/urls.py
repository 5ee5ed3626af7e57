"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a pattern of literal text with the signs

    ||   at the start: the beginning of the host or of one of its parent domains
    |    at the start or end: the beginning of the host, the end of the url
    *    any run of characters
    ^    a character that is no letter, digit, ``-``, ``_``, ``.`` or ``%``, or the end

Tokens of a rule are its runs of letters and digits that are whole in every url it fits:
both neighbours are other literal characters, ``^`` or an anchor. The rule is filed
under the one that is rarest among all urls. A url looks up its own tokens there and
only the rules it finds are run as regular expressions. The index is one literal of the plan: as many
buckets as tokens, so that a look-up takes the same time whatever the number of rules.

Only DataFrame functions are used, without a shuffle but for the token counts.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorstream.llm.common import fresh_name

TOKEN = re.compile(r"[A-Za-z0-9]+")
#: Rules travel with the plan, some 200 bytes each; a longer list is refused.
MOST_RULES = 20_000
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """``pattern`` as above. ``site`` rules name a host and the beginning of a path; the longest
    that fits decides, before all patterns. Of patterns, an allowing one goes before a blocking one."""

    verdict: str
    pattern: str
    site: bool = False
    ignore_case: bool = False

    @classmethod
    def of_site(cls, verdict: str, host: str, path: str) -> "Rule":
        return cls(verdict, host + path, site=True)

    @property
    def regex(self) -> str:
        if self.site:
            host, slash, path = self.pattern.partition("/")
            return rf"{self._flags}^(?:[^/?#]*\.)?{_quoted(host)}{_quoted(slash + path)}"
        out, rest, end = self._flags, self.pattern, ""
        if rest.startswith("||"):
            out, rest = out + r"^(?:[^/?#]*\.)?", rest[2:]
        elif rest.startswith("|"):
            out, rest = out + "^", rest[1:]
        if rest.endswith("|"):
            rest, end = rest[:-1], r"\z"
        for char in rest:
            out += {"*": ".*", "^": r"(?:[^A-Za-z0-9_.%-]|$)"}.get(char) or _quoted(char)
        return out + end

    @property
    def _flags(self) -> str:
        return "(?i)" if self.ignore_case else ""

    @property
    def tokens(self) -> list[str]:
        """Lower-case runs that are whole tokens of every url the rule fits."""
        text = f"/{self.pattern}" if self.site else self.pattern
        found = []
        for match in TOKEN.finditer(text):
            before, after = text[: match.start()][-1:], text[match.end() :][:1]
            if before not in ("", "*") and after not in ("", "*"):
                found.append(match.group().lower())
        return found


def _quoted(text: str) -> str:
    """Literal text for the regular expressions of Java and of RE2."""
    return re.sub(r"([^A-Za-z0-9_/])", r"\\\1", text)


def parse_rules(lines: Iterable[str]) -> list[Rule]:
    """Pattern rules of a list, one to a line.

    ``@@`` at the start allows, else a rule blocks; ``$match-case`` at the end heeds case, which rules of a list do not
    otherwise. Empty lines, ``!`` comments and a ``[title]`` are passed over. Rules with other options, or for parts
    of a page (``##``), are no url rules and stop the reading: leaving them out is the caller's choice.
    """
    rules = []
    for number, line in enumerate(lines, 1):
        pattern = line.strip()
        if not pattern or pattern.startswith("!") or re.fullmatch(r"\[.*\]", pattern):
            continue
        verdict = BLOCK
        if pattern.startswith("@@"):
            verdict, pattern = ALLOW, pattern[2:]
        pattern, _, options = pattern.partition("$")
        if re.search(r"#[@?]?#", pattern) or options not in ("", "match-case") or not pattern.strip("|*"):
            raise ValueError(f"line {number} is no url rule: {line.strip()!r}")
        rules.append(Rule(verdict, pattern, ignore_case=not options))
    return rules


def read_rules(path: str) -> list[Rule]:
    """The rules of a text file in the form of :func:`parse_rules`."""
    with open(path, encoding="utf-8") as lines:
        return parse_rules(lines)


#: The rules of the contract, and patterns for hosts and paths of advertising, spam and gambling.
SITE_RULES = [
    Rule.of_site(ALLOW, "com", "/"),
    Rule.of_site(BLOCK, "example.com", "/en/"),
    Rule.of_site(ALLOW, "www.example.com", "/en/"),
    Rule.of_site(BLOCK, "net", "/es/"),
    Rule.of_site(BLOCK, "net", "/fr/"),
]
PATTERN_RULES = [
    Rule(BLOCK, "||ads-track.*^"),
    Rule(BLOCK, "||spam-farm.*^"),
    Rule(BLOCK, "||casino-win.*^"),
    Rule(BLOCK, ".doubleclick."),
    Rule(BLOCK, "/banner/*/click"),
    Rule(BLOCK, "/phishing/"),
    Rule(BLOCK, "?affiliate="),
    Rule(BLOCK, "&affiliate="),
    Rule(ALLOW, "/robots.txt^"),
]
RULES = [*SITE_RULES, *PATTERN_RULES]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    found = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def after_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*((?s:.*))$", 1)


def _tokens(text: Column) -> Column:
    return F.array_distinct(F.split(F.lower(text), "[^a-z0-9]+"))


ENTRY = "struct<rank:int,number:int,site:boolean,text:string,verdict:string,regex:string>"


def _literal(value, ddl: str) -> Column:
    """One literal for all: thousands of them take the planner long."""
    return F.from_json(F.lit(json.dumps({"all": value})), f"struct<all:{ddl}>")["all"]


class _Buckets:
    """Values by token, in as many buckets as tokens, by crc32."""

    def __init__(self, values: dict[str, list], ddl: str) -> None:
        self.size = max(1, len(values))
        buckets: list[list[dict]] = [[] for _ in range(self.size)]
        for token, kept in sorted(values.items()):
            buckets[zlib.crc32(token.encode()) % self.size].append({"token": token, "kept": kept})
        self.table = _literal(buckets, f"array<array<struct<token:string,kept:array<{ddl}>>>>")

    def of(self, token: Column) -> Column:
        """The token's values in an array of one array, empty if it has none."""
        bucket = F.get(self.table, (F.crc32(token.cast("binary")) % self.size).cast("int"))
        return F.transform(F.filter(bucket, lambda b: b["token"] == token), lambda b: b["kept"])


class UrlFilter:
    """Rules filed by the token that is rarest in ``urls``, a column of a table."""

    def __init__(self, pages: DataFrame, rules: list[Rule] = RULES, url: str = "url") -> None:
        if len(rules) > MOST_RULES:
            raise ValueError(f"{len(rules)} rules are more than {MOST_RULES}")
        self.rules = rules
        wanted = sorted({t for rule in rules for t in rule.tokens})
        address = F.coalesce(F.col(url), F.lit(""))
        target = F.concat(host_of(address), after_host(address))
        ours = _Buckets({w: [] for w in wanted}, "int")
        asked = F.filter(_tokens(target), lambda t: F.size(ours.of(t)) > 0)
        # At most one row per token of the rules comes back.
        counted = (
            pages.select(F.explode(asked).alias("token"))
            .groupBy("token")
            .count()
            .collect()
        )
        self.counts = {r["token"]: r["count"] for r in counted}
        #: Rules by token; those without a whole token are tried on every url, under "".
        self.index: dict[str, list[int]] = {}
        for number, rule in enumerate(rules):
            best = min(rule.tokens, key=lambda t: (self.counts.get(t, 0), -len(t), t), default="")
            self.index.setdefault(best, []).append(number)

    def judge(self, pages: DataFrame, url: str = "url") -> tuple[DataFrame, dict[str, str]]:
        """``pages`` with new columns, whose names are the second value.

        ``host`` and ``path`` (empty for a null url or one without ``://``), ``rule`` (the longest
        fitting site rule, else null), ``pattern`` (the deciding pattern rule if no site rule fits, else null),
        ``candidates`` (rules whose expressions were run) and ``verdict``: that of the rule,
        else of the pattern, else allow. Rows are judged one by one, repeated or not.
        """
        names = {k: fresh_name(k) for k in ("host", "path", "rule", "pattern", "candidates", "verdict")}
        address = F.coalesce(F.col(url), F.lit(""))
        host, rest = fresh_name("host"), fresh_name("rest")
        found, fits = fresh_name("found"), fresh_name("fits")
        target = F.concat(F.col(host), F.col(rest))
        entries = {token: [self._entry(k) for k in numbers] for token, numbers in self.index.items()}
        everywhere = entries.pop("", [])
        index = _Buckets(entries, ENTRY)

        def fitting(rules: Column) -> Column:
            return F.filter(rules, lambda r: F.regexp_like(target, r["regex"]))

        fit = fitting(F.col(found))
        if everywhere:
            # As one expression, compiled once, since few urls fit any of them.
            any_of_them = "|".join(f"(?:{rule['regex']})" for rule in everywhere)
            rest_of_them = F.when(target.rlike(any_of_them), fitting(_literal(everywhere, f"array<{ENTRY}>")))
            fit = F.concat(fit, F.coalesce(rest_of_them, F.array().cast(f"array<{ENTRY}>")))
        judged = (
            pages.withColumn(host, host_of(address))
            .withColumn(rest, after_host(address))
            .withColumn(found, F.flatten(F.flatten(F.transform(_tokens(target), index.of))))
            .withColumn(fits, fit)
        )

        def least(keep) -> Column:
            return F.array_min(F.filter(F.col(fits), keep))

        site, pattern = least(lambda r: r["site"]), least(lambda r: ~r["site"])
        verdict = F.coalesce(site["verdict"], pattern["verdict"], F.lit(ALLOW))
        out = [
            *(F.col(f"`{c}`") for c in pages.columns),
            F.col(host).alias(names["host"]),
            F.regexp_extract(F.col(rest), "^([^?#]*)", 1).alias(names["path"]),
            site["text"].alias(names["rule"]),
            F.when(site.isNull(), pattern["text"]).alias(names["pattern"]),
            (F.size(found) + len(everywhere)).alias(names["candidates"]),
            verdict.alias(names["verdict"]),
        ]
        return judged.select(*out), names

    def _entry(self, number: int) -> dict:
        rule = self.rules[number]
        # Ordered so that the least struct decides: longest site first, allowing pattern first.
        rank = -len(rule.pattern) if rule.site else int(rule.verdict == BLOCK)
        return {
            "rank": rank,
            "number": number,
            "site": rule.site,
            "text": rule.pattern,
            "verdict": rule.verdict,
            "regex": rule.regex,
        }
