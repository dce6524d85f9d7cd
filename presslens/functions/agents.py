"""User-agent fields from an ordered rule table.

The rules cover the main browser, system and device families of web traffic and are evaluated as
regular expressions inside the projection, so no lookup join and no Python worker is involved.
Apply them after the day aggregate has reduced a browser to one user agent.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELDS = (
    "browser_family", "browser_version", "os_family", "os_version",
    "device_family", "device_brand", "device_model",
    "is_desktop", "is_tablet", "is_mobile",
)


@dataclass(frozen=True)
class AgentRules:
    """``(marker, name, version pattern)`` triples, first match wins."""

    browsers: tuple[tuple[str, str, str], ...] = (
        # Product tokens of the user-agent grammar.
        ("Edg(e|A|iOS)?/", "Edge", "Edg(?:e|A|iOS)?/([0-9]+(?:[.][0-9]+){0,2})"),
        ("OPR/|Opera", "Opera", "(?:OPR|Opera)[/ ]([0-9]+(?:[.][0-9]+){0,2})"),
        ("SamsungBrowser/", "Samsung Internet", "SamsungBrowser/([0-9]+(?:[.][0-9]+){0,2})"),
        ("FxiOS/", "Firefox iOS", "FxiOS/([0-9]+(?:[.][0-9]+){0,2})"),
        ("Firefox/.*Mobile|Mobile.*Firefox/", "Firefox Mobile", "Firefox/([0-9]+(?:[.][0-9]+){0,2})"),
        ("Firefox/", "Firefox", "Firefox/([0-9]+(?:[.][0-9]+){0,2})"),
        ("CriOS/", "Chrome Mobile iOS", "CriOS/([0-9]+(?:[.][0-9]+){0,2})"),
        ("Chrome/.*Mobile", "Chrome Mobile", "Chrome/([0-9]+(?:[.][0-9]+){0,2})"),
        ("Chrome/", "Chrome", "Chrome/([0-9]+(?:[.][0-9]+){0,2})"),
        ("(iPhone|iPad|iPod).*Safari/", "Mobile Safari", "Version/([0-9]+(?:[.][0-9]+){0,2})"),
        ("Safari/", "Safari", "Version/([0-9]+(?:[.][0-9]+){0,2})"),
        ("MSIE |Trident/", "IE", "(?:MSIE |rv:)([0-9]+(?:[.][0-9]+){0,2})"),
    )
    systems: tuple[tuple[str, str, str], ...] = (
        # Platform tokens of the user-agent grammar.
        ("iPhone|iPad|iPod", "iOS", "OS ([0-9]+(?:_[0-9]+){0,2})"),
        ("Android", "Android", "Android ([0-9]+(?:[.][0-9]+){0,2})"),
        ("Windows NT", "Windows", "Windows NT ([0-9]+(?:[.][0-9]+)?)"),
        ("Mac OS X", "Mac OS X", "Mac OS X ([0-9]+(?:[_.][0-9]+){0,2})"),
        ("CrOS", "Chrome OS", "CrOS [^ ]+ ([0-9]+(?:[.][0-9]+){0,2})"),
        ("Linux", "Linux", "Linux ([0-9]+(?:[.][0-9]+){0,2})"),
    )
    # Model token prefix -> maker.
    makers: dict[str, str] = field(
        default_factory=lambda: {
            "(SM|GT|SCH|SGH)-": "Samsung",
            "(HUAWEI|Huawei|ELE|VOG|ANE|MAR)[- ]": "Huawei",
            "(Redmi|Mi|MI|POCO) ": "XiaoMi",
            "Pixel": "Google",
            "Nokia": "Nokia",
            "(LG|LM)-": "LG",
            "ONEPLUS": "OnePlus",
            "(moto|Moto)": "Motorola",
        }
    )


# Windows kernel version -> marketing name; others keep the kernel version.
WINDOWS_NAMES = {"10.0": "10", "6.3": "8.1", "6.2": "8", "6.1": "7", "6.0": "Vista", "5.1": "XP"}
APPLE_DEVICE = "(iPhone|iPad|iPod|Macintosh)"
ANDROID_MODEL = "Android[^;)]*; ([^;)]+?)(?: Build/[^;)]*)?[;)]"


def _first_match(agent: Column, rules, pick, default) -> Column:
    chain = None
    for rule in rules:
        test = agent.rlike(rule[0])
        chain = F.when(test, pick(rule)) if chain is None else chain.when(test, pick(rule))
    return chain.otherwise(default)


def agent_fields(agent: Column, rules: AgentRules | None = None) -> dict[str, Column]:
    """``FIELDS`` as expressions over one user-agent text; flags are booleans."""
    rules = rules or AgentRules()

    def version(rule) -> Column:
        return F.regexp_replace(F.regexp_extract(agent, rule[2], 1), "_", ".")

    browser = _first_match(agent, rules.browsers, lambda r: F.lit(r[1]), F.lit("Other"))
    browser_version = _first_match(agent, rules.browsers, version, F.lit(""))
    system = _first_match(agent, rules.systems, lambda r: F.lit(r[1]), F.lit("Other"))
    raw_version = _first_match(agent, rules.systems, version, F.lit(""))
    windows = F.create_map(*[F.lit(x) for pair in WINDOWS_NAMES.items() for x in pair])
    system_version = F.when(
        system == "Windows", F.coalesce(F.try_element_at(windows, raw_version), raw_version)
    ).otherwise(raw_version)

    apple = F.regexp_extract(agent, APPLE_DEVICE, 1)
    apple_name = F.when(apple == "Macintosh", F.lit("Mac")).otherwise(apple)
    android = F.regexp_extract(agent, ANDROID_MODEL, 1)
    maker = None
    for prefix, name in rules.makers.items():
        test = android.rlike("^" + prefix)
        maker = F.when(test, F.lit(name)) if maker is None else maker.when(test, F.lit(name))
    maker = maker.otherwise(F.lit("Generic_Android"))

    is_apple, is_android = apple != "", (android != "") & (system == "Android")
    tablet = agent.rlike("iPad|Tablet") | (is_android & ~agent.rlike("Mobile"))
    mobile = ~tablet & agent.rlike("iPhone|iPod|Mobile")
    return {
        "browser_family": browser,
        "browser_version": browser_version,
        "os_family": system,
        "os_version": system_version,
        "device_family": F.when(is_apple, apple_name)
        .when(is_android & (maker != "Generic_Android"), F.concat(maker, F.lit(" "), android))
        .when(is_android, android)
        .otherwise(F.lit("Other")),
        "device_brand": F.when(is_apple, F.lit("Apple")).when(is_android, maker),
        "device_model": F.when(is_apple, apple_name).when(is_android, android),
        "is_desktop": F.coalesce(~tablet & ~mobile & system.isin(
            "Windows", "Mac OS X", "Linux", "Chrome OS"), F.lit(False)),
        "is_tablet": F.coalesce(tablet, F.lit(False)),
        "is_mobile": F.coalesce(mobile, F.lit(False)),
    }
