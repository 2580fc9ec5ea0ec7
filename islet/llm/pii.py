"""Surrogates for personal data, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from islet.llm.common import enter, keep, leave

#: kind -> pattern; the first that fits at a place names its kind. Runs are entered at their start only, so scanning stays linear.
_V4 = r"(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_HEX = r"[0-9A-Fa-f]{1,4}"
_TITLES = {
    "f": ["Mrs", "Ms", "Miss", "Lady", "Dame", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "г-жа", "госпожа", "Κυρία", "κυρία"],
    "m": ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "г-н", "господин", "Κύριος", "κύριος"],
    "n": ["Dr", "Prof", "Professor"],
}
#: What a name is made of behind its title: particles, parts with hyphens and apostrophes, or a run of one of the scripts without capitals.
_PARTICLE = r"(?:(?:al|el|de|da|di|du|del|dos|van|von|der|den|ter|la|le|bin|ibn|abu)[\x20-]){0,3}"
_PART = rf"{_PARTICLE}(?:\p{{Lu}}['’])?\p{{Lu}}\p{{L}}+(?:[-'’]\p{{Lu}}\p{{L}}+)*"
_NAME = rf"(?:{_PART}(?:\x20{_PART}){{0,2}}|[\p{{IsHan}}\p{{IsHiragana}}\p{{IsKatakana}}]{{1,8}}|\p{{IsHangul}}{{1,5}})"
#: Country codes by their first digits: of one digit, of two, else of three. Fixed values of the numbering plan.
COUNTRY = r"^\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
_ALL_TITLES = "|".join(sorted((t for some in _TITLES.values() for t in some), key=len, reverse=True))
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}0-9-]+(?:\.[\p{L}0-9-]+)+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip6": rf"(?<![0-9A-Za-z:.])(?:(?:{_HEX}:){{7}}{_HEX}|{_HEX}(?::{_HEX}){{0,5}}::(?:{_HEX}(?::{_HEX}){{0,5}})?)(?![0-9A-Za-z:])",
    "ip": rf"(?<![0-9.]){_V4}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[-.][0-9]{3}[-.][0-9]{4}|(?<=\b(?:[Tt]el|[Pp]hone|[Ff]on|[Ff]ax|[Mm]obile|[Cc]all)[.:]?\x20{0,2})[0-9]{7,12})(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    "name": rf"(?<!\p{{L}})(?:{_ALL_TITLES})\.?\x20{_NAME}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_NUMBERS = "|".join(f"(?:{PATTERNS[k]})" for k in ("iban", "ip6", "ip", "ssn", "phone", "card"))
TITLE = r"^\S+\x20"

#: Fixed lists of surrogate names. Given names by (script, gender); family names are a stem and an ending.
GIVEN = {
    ("latin", "f"): "anna clara emma ida julia karla laura marta nina olga paula rosa sara tessa vera wanda".split(),
    ("latin", "m"): "adam bruno carl david emil felix georg hugo ivan jonas karl leon marco niklas oscar paul".split(),
    ("cyrillic", "f"): "анна вера дарья елена зоя ирина ксения лидия мария нина ольга полина раиса софья тамара юлия".split(),
    ("cyrillic", "m"): "антон борис виктор глеб денис егор захар игорь кирилл лев максим никита олег павел роман фёдор".split(),
    ("han", "f"): "芳 静 敏 丽 娜 秀英 美咲 葵 陽菜 结衣 花子 雪 梅 玲 燕 霞".split(),
    ("han", "m"): "伟 强 磊 洋 勇 军 健 翔太 大輔 拓也 太郎 明 刚 平 辉 超".split(),
    ("hangul", "f"): "지은 서연 민지 수진 하은 유진 은영 미경 지현 소영 예진 혜진 정은 윤서 다은 선영".split(),
    ("hangul", "m"): "민수 준호 성민 현우 지훈 도윤 영호 상철 동현 재현 승우 태민 진우 경수 우진 종혁".split(),
    ("greek", "f"): "άννα βάσια δανάη ελένη ζωή ηλέκτρα θάλεια ιωάννα καίτη λίνα μαρία νίκη όλγα ρένα σοφία χαρά".split(),
    ("greek", "m"): "άγγελος βασίλης γιάννης δήμος ηλίας θάνος κώστας λάμπρος μάνος νίκος πέτρος σάκης τάσος φώτης χάρης ορέστης".split(),
}
STEMS = {
    "han": "林 森 高 石 白 江 金 安 原 松 竹 水 黒 青 大 小".split(),
    "hangul": "김 이 박 최 정 강 조 윤 장 임 한 오 서 신 권 황".split(),
    "latin": "al ber cor dal eb fal gru hol il jan kel lam mor nov ol pal".split(),
    "cyrillic": "антон бел власт гром демид ерш жук зор калин лап мороз нос орл пан рог сокол".split(),
    "greek": "αλεξ βαλ γρηγορ δημ ευθυμ ζαφειρ ηλι θεοδωρ καρ λαμπρ μαν νικολ παπ ραφτ σταμ χρηστ".split(),
}
ENDS = {
    ("han", "f"): "田 村 川 本 山 野 島 崎".split(),
    ("hangul", "f"): "산 강 원 천 주 양 성 남".split(),
    ("latin", "f"): "an bert den er feld gard holm in ken lund man ner quist rup sen ton".split(),
    ("cyrillic", "f"): "ова ина ская енко ева ушкина юк овская".split(),
    ("cyrillic", "m"): "ов ин ский енко ев ушкин юк овский".split(),
    ("greek", "f"): "ίδου οπούλου άκη έα ιάδου ούση".split(),
    ("greek", "m"): "ίδης όπουλος άκης έας ιάδης ούσης".split(),
}
SCRIPTS = ("latin", "cyrillic", "greek", "han", "hangul")
for _script in ("latin", "han", "hangul"):
    ENDS[_script, "m"] = ENDS[_script, "f"]
for _script in SCRIPTS:  # of unknown gender: any given name, and the endings of one
    GIVEN[_script, "n"], ENDS[_script, "n"] = GIVEN[_script, "f"] + GIVEN[_script, "m"], ENDS[_script, "m"]
GROW, ROUNDS = 4, 64


def holds_any(text: Column) -> Column:
    """Whether a text has anything that ANY fits, by cheap tests first."""
    return (F.contains(text, F.lit("@")) & text.rlike(PATTERNS["email"])) | (text.rlike("[0-9]|::") & text.rlike(_NUMBERS)) | text.rlike(PATTERNS["name"])


def kind_of(value: Column) -> Column:
    out = F.lit("name")
    for kind in ("card", "phone", "ssn", "ip", "ip6", "iban", "email"):
        whole = PATTERNS[kind] if kind != "phone" else PATTERNS[kind].replace("(?<=", "(?:|").replace("|(?:|", "|(?<![0-9])(?:|")
        out = F.when(value.rlike(f"^(?:{whole})$"), kind).otherwise(out)
    return out


def luhn_sum(digits: Column, last: bool) -> Column:
    """The card sum of digits, where the last one is (or isn't) the check digit."""
    doubled = F.transform(F.split(digits, ""), lambda c, i: F.when((F.length(digits) - 1 - i) % 2 == int(last), c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x)


def iban_rest(account: Column) -> Column:
    """The remainder by 97 of country, check digits and account, in the order that the check wants; letters are 10 to 35."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, F.lit(1), F.lit(4)))
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def canonical(kind: Column, value: Column) -> Column:
    """What makes two mentions one entity, but for names: digits of numbers (without a leading 1 of eleven, with any other country's code apart: ``+49 301234567``), account numbers without blanks, lower case of the others."""
    digits = _digits(value)
    country = F.regexp_extract(value, COUNTRY, 1)
    abroad = F.concat(F.lit("+"), country, F.lit(" "), F.substring(digits, F.length(country) + 1, F.length(digits)))
    phone = F.when((F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)).when((country != "") & (country != "1"), abroad).otherwise(digits)
    return F.when(kind == "phone", phone).when(kind.isin("card", "ssn"), digits).when(kind == "iban", F.replace(value, F.lit(" "))).otherwise(F.lower(value))


def with_persons(mentions: DataFrame) -> DataFrame:
    """Adds full (a name of two parts) and, for names, canon: gender and name.

    Within a text a single name is the person of that family name and a fitting gender who is named in full there, if there is
    only one; a title without gender takes the one that the text gives the same full name.
    """
    female, neutral = (rf"^(?:{'|'.join(_TITLES[g])})\.?\x20" for g in "fn")
    told = mentions.withColumn("bare", F.lower(F.regexp_replace("value", TITLE, ""))).withColumn("g", F.when(F.col("value").rlike(female), "f").when(F.col("value").rlike(neutral), "n").otherwise("m"))
    told = told.withColumn("full", (F.col("kind") == "name") & F.contains("bare", F.lit(" "))).withColumn("family", F.substring_index("bare", " ", -1))
    here = Window.partitionBy("tk", "tl", F.coalesce(F.col("kind") == "name", F.lit(False)), "family")
    told = told.withColumn("fulls", F.collect_set(F.when(F.col("full"), F.struct("g", "bare"))).over(here))
    genders = lambda some: F.array_distinct(F.filter(F.transform(some, lambda x: x["g"]), lambda g: g != "n"))
    same = genders(F.filter("fulls", lambda x: x["bare"] == F.col("bare")))
    fits = F.filter("fulls", lambda x: (x["g"] == F.col("g")) | (x["g"] == "n") | (F.col("g") == "n"))
    persons = F.array_distinct(F.transform(fits, lambda x: x["bare"]))
    sole = lambda some: F.when(F.size(some) == 1, F.get(some, F.lit(0)))
    own = F.when((F.col("g") == "n") & F.col("full"), F.coalesce(sole(same), F.lit("n"))).otherwise(F.col("g"))
    known = ~F.col("full") & (F.size(persons) == 1) & (F.size(genders(fits)) <= 1)
    name = F.when(known, F.concat_ws(" ", F.coalesce(sole(genders(fits)), F.lit("n")), F.get(persons, F.lit(0)))).otherwise(F.concat_ws(" ", own, "bare"))
    return told.withColumn("canon", F.when(F.col("kind") == "name", name).otherwise(F.col("canon"))).drop("bare", "g", "family", "fulls")


def _pick(names: list[str], digest: Column, at: int) -> Column:
    return F.get(F.array(*map(F.lit, names)), F.conv(F.substring(digest, at, 2), 16, 10).cast("int") % len(names))


def surrogate(kind: Column, canon: Column, attempt: Column, key: str, host: Column | None = None) -> Column:
    """A keyed stand-in of the same form for a canonical value; every attempt gives another. ``host``: the surrogate of an e-mail's domain.

    From attempt GROW on it is longer by a keyed letter, digit, octet or name per attempt, so that there are always
    enough of them, however few the form itself allows.
    """
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string")), 256)
    numerals = lambda d: F.translate(d, "abcdef", "073951")
    letters = lambda d, of="bcdfghjklmnprstv": F.translate(d, "0123456789abcdef", of)
    more, extra = F.sha2(digest, 256), F.least(F.greatest(attempt - GROW + 1, F.lit(0)), F.lit(64))

    def alike(text: Column, d: Column) -> Column:
        one = lambda c, i: F.when(c.rlike("[a-z]"), F.substring(letters(d), i % 64 + 1, F.lit(1))).when(c.rlike("[A-Z]"), F.upper(F.substring(letters(d), i % 64 + 1, F.lit(1)))).when(c.rlike("[0-9]"), F.substring(numerals(d), i % 64 + 1, F.lit(1)))
        # letters of other scripts by some of their own, any further ones by Latin ones
        other = lambda c, i: F.when(c.rlike(r"\p{IsCyrillic}"), F.substring(letters(d, "бвгджзклмнпрстфх"), i % 64 + 1, F.lit(1))).when(c.rlike(r"\p{IsGreek}"), F.substring(letters(d, "βγδζθκλμνξπρστφψ"), i % 64 + 1, F.lit(1))).when(c.rlike(r"[\p{L}\p{N}]"), F.substring(letters(d), i % 64 + 1, F.lit(1))).otherwise(c)
        return F.array_join(F.transform(F.split(text, ""), lambda c, i: F.coalesce(one(c, i), other(c, i))), "")

    grown = F.substring(letters(more), F.lit(1), extra)
    top = F.substring_index(canon, ".", -1)
    domain = F.concat(alike(F.substring(canon, F.lit(1), F.length(canon) - F.length(top) - 1), digest), grown, F.lit("."), top)
    email = F.concat(alike(F.substring_index(canon, "@", 1), digest), grown, F.lit("@"), host if host is not None else F.substring_index(canon, "@", -1))
    octet = lambda i: (F.conv(F.substring(digest, 1 + 3 * i, 3), 16, 10).cast("int") % 254 + 1).cast("string")
    chosen = lambda make: F.when(extra > 0, F.array_join(F.transform(F.sequence(F.lit(1), extra), make), "")).otherwise("")
    byte = lambda i: F.conv(F.substring(more, 2 * (i % 32) + 1, F.lit(2)), 16, 10).cast("int")
    ip = F.concat(F.concat_ws(".", *[octet(i) for i in range(4)]), chosen(lambda i: F.concat(F.lit("."), (byte(i) % 254 + 1).cast("string"))))
    hexes = F.array_join(F.transform(F.split(canon, ""), lambda c, i: F.when(c == ":", c).otherwise(F.substring(digest, i % 64 + 1, F.lit(1)))), "")
    ip6 = F.concat(hexes, chosen(lambda i: F.concat(F.lit(":"), F.lpad(F.hex(byte(i).cast("long")), 2, "1"))))
    tail = F.substring(numerals(more), F.lit(1), extra)
    code = F.regexp_extract(canon, r"^\+[0-9]+ ", 0)  # a phone number's country
    number = F.concat(code, F.substring(numerals(digest), F.lit(1), F.length(canon) - F.length(code)), tail)
    payload = F.concat(F.substring(canon, 1, 1), F.substring(numerals(digest), F.lit(1), F.length(canon) - 2), tail)
    check = (10 - luhn_sum(payload, False) % 10) % 10
    account = F.concat(alike(F.substring(canon, F.lit(5), F.length(canon)), digest), tail)
    country = F.substring(canon, 1, 2)
    iban = F.concat(country, F.lpad((98 - iban_rest(F.concat(country, F.lit("00"), account))).cast("string"), 2, "0"), account)
    name = None
    for (script, gender), given in GIVEN.items():
        # two stems and an ending: some thousand families, and some ten thousand full names, before any needs a hyphen
        family = lambda at: F.concat(_pick(STEMS[script], digest, at), _pick(STEMS[script], digest, at + 2), _pick(ENDS[script, gender], digest, at + 4))  # noqa: B023, E731
        two = F.when(canon.rlike(r"^. \S+[ -]\S"), F.concat(_pick(given, digest, 1), F.lit(" "), family(3))).otherwise(family(3))
        joined = F.when(attempt > 0, F.concat(two, F.lit("-"), family(9), F.when(attempt > 2, F.concat(F.lit("-"), family(15), F.lit("-"), family(21))).otherwise(""))).otherwise(two)
        other = "|".join(rf"\p{{Is{x.title()}}}" for x in SCRIPTS[1:])
        fits = canon.startswith(f"{gender} ") & (~canon.rlike(other) if script == "latin" else canon.rlike(rf"\p{{Is{script.title()}}}"))
        further = chosen(lambda i: F.concat(F.lit("-"), F.get(F.array(*map(F.lit, STEMS[script])), byte(i) % len(STEMS[script])), F.lit(ENDS[script, gender][0])))  # noqa: B023
        whole = F.concat(F.lit(f"{gender} "), joined, further)
        name = F.when(fits, whole) if name is None else name.when(fits, whole)
    of = {"email": email, "domain": domain, "ip": ip, "ip6": ip6, "iban": iban, "card": F.concat(payload, check.cast("string")), "name": name}
    out = number
    for k, c in of.items():
        out = F.when(kind == k, c).otherwise(out)
    return out


def rendered(kind: Column, value: Column, canon: Column, new: Column, full: Column) -> Column:
    """The surrogate in the mention's own format: its separators, country code, title and letter case; what it is longer by follows. Single names get the person's family name."""
    code = F.regexp_extract(canon, r"^\+[0-9]+ ", 0)
    value_of = lambda c: F.substring(c, F.length(code) + 1, F.length(c))
    canon, new = F.when(kind == "phone", value_of(canon)).otherwise(canon), F.when(kind == "phone", value_of(new)).otherwise(new)
    signs = F.when(kind == "iban", "[A-Za-z0-9]").otherwise("[0-9]")
    extra = F.length(F.regexp_replace(value, F.concat(F.lit("[^"), F.substring(signs, F.lit(2), F.length(signs))), F.lit(""))) - F.length(canon)
    filled = F.aggregate(
        F.split(value, ""),
        F.struct(F.lit(0).alias("i"), F.lit("").alias("out")),
        lambda a, c: F.when(~F.rlike(c, signs), F.struct(a["i"].alias("i"), F.concat(a["out"], c).alias("out")))
        .when(a["i"] < extra, F.struct((a["i"] + 1).alias("i"), F.concat(a["out"], c).alias("out")))
        .otherwise(F.struct((a["i"] + 1).alias("i"), F.concat(a["out"], F.substring(new, a["i"] - extra + 1, F.lit(1))).alias("out"))),
        lambda a: F.concat(a["out"], F.substring(new, F.length(canon) + 1, F.length(new))),
    )

    def like(old: Column, text: Column) -> Column:
        each = F.array_join(F.zip_with(F.split(old, ""), F.split(text, ""), lambda c, n: F.when(c != F.lower(c), F.upper(n)).otherwise(n)), "")
        return F.when((old == F.upper(old)) & (old != F.lower(old)), F.upper(text)).otherwise(each)

    cased = F.concat_ws("@", *[like(F.substring_index(value, "@", i), F.substring_index(new, "@", i)) for i in (1, -1)])
    bare = F.when(full, F.substring(new, F.lit(3), F.length(new))).otherwise(F.substring_index(F.substring(new, F.lit(3), F.length(new)), " ", -1))
    hyphens = F.array_join(F.transform(F.split(F.initcap(F.regexp_replace(bare, "-", " - ")), " - "), lambda x: F.trim(x)), "-")
    old = F.regexp_replace(value, TITLE, "")
    name = F.concat(F.regexp_extract(value, TITLE, 0), F.when(old == F.upper(old), F.upper(bare)).otherwise(hyphens))
    return F.when(kind.isin("phone", "card", "ssn", "iban"), filled).when(kind == "email", cased).when(kind == "name", name).otherwise(new)


def distinct_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, host) -> (kind, canon, new): no two entities of a kind share a surrogate, and none is itself an entity of the input.

    In each round every entity left proposes one; of those that propose the same the smallest value gets it, unless it is
    taken or real, and the others propose again. What can be proposed grows with the rounds, so few of them end it: from the round GROW
    on each makes at least eight times as many, so ROUNDS are enough for far more than 10**40 entities of a kind, and never end in the error below.
    """
    entities = keep(entities)
    done, left = None, entities
    for attempt in range(ROUNDS):
        asked = left.withColumn("new", surrogate(F.col("kind"), F.col("canon"), F.lit(attempt), key, F.col("host")))
        first = asked.groupBy("kind", "new").agg(F.min("canon").alias("canon"))
        first = first.join(entities.select("kind", F.col("canon").alias("new")), ["kind", "new"], "left_anti")
        if done is not None:
            first = first.join(done.select("kind", "new"), ["kind", "new"], "left_anti")
        given = first.select("kind", "canon", "new")
        done = keep(given if done is None else done.union(given))
        left = keep(entities.join(done.select("kind", "canon"), ["kind", "canon"], "left_anti"))
        if left.isEmpty():
            return done
    raise RuntimeError(f"entities without a surrogate after {ROUNDS} rounds: {left.count()}")


def replace_entities(docs: DataFrame, *, text: str = "text", key: str = "islet") -> DataFrame:
    """Adds n_entities and surrogate_text, the text with every detected entity replaced.

    Entities are e-mail and IP addresses, phone and social-security numbers, cards and accounts with valid check digits, and
    names after a title of respect, in Latin, Cyrillic, Greek, Han or Hangul letters, with particles, hyphens and apostrophes. Their surrogates are keyed, so one entity has one surrogate in all
    documents and mentions (coreference), two entities have two (see ``distinct_surrogates``), and each keeps kind and form: e-mails
    keep their shape and top-level domain, one domain stays one domain and two stay two, cards keep their first digit, accounts their
    country, both have valid check digits, phone numbers keep separators and country code, names keep title, gender, script and letter case.
    Within a text a single name after a title is the person whose full name the text also gives, and the full name is replaced
    without a title too (n_entities counts the others); names that no title comes before anywhere in their text aren't found.
    Kana count as Han and get Latin names. A number with a country code and one without are two, but for the code 1.

    Null text is an empty text. Equal texts get equal results; repeated rows each come back. Input columns named like an
    added column are replaced; an empty table gives an empty table. Only texts with entities are shuffled, once.
    """
    flat, names = enter(docs, text=text)
    flat = flat.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    flat = flat.withColumn("tk", F.xxhash64("text")).withColumn("tl", F.length("text"))
    has = holds_any(F.col("text"))
    mentions = flat.where(has).select("tk", "tl", F.posexplode(F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).alias("i", "value")).groupBy("tk", "tl", "i").agg(F.first("value").alias("value"))
    mentions = mentions.withColumn("kind", kind_of(F.col("value"))).withColumn("canon", canonical(F.col("kind"), F.col("value")))
    # what has no valid check digits only looks like an entity: its kind is null
    valid = F.when(F.col("kind") == "card", luhn_sum(F.col("canon"), True) % 10 == 0).when(F.col("kind") == "iban", iban_rest(F.col("canon")) == 1).otherwise(True)
    mentions = keep(with_persons(mentions.withColumn("kind", F.when(valid, F.col("kind")))))
    real = mentions.where("kind IS NOT NULL").select("kind", "canon").distinct()
    host = F.when(F.col("kind") == "email", F.substring_index("canon", "@", -1))
    domains = distinct_surrogates(real.select(F.lit("domain").alias("kind"), host.alias("canon"), F.lit(None).cast("string").alias("host")).where("canon IS NOT NULL").distinct(), key)
    hosted = real.withColumn("own", host).join(domains.select(F.col("canon").alias("own"), F.col("new").alias("host")), "own", "left").select("kind", "canon", "host")
    known = distinct_surrogates(hosted, key)
    found = mentions.join(known, ["kind", "canon"], "left").withColumn("new", F.when(F.col("kind").isNull(), F.col("value")).otherwise(rendered(F.col("kind"), F.col("value"), F.col("canon"), F.col("new"), F.col("full"))))
    person = F.when(F.col("full"), F.struct(F.regexp_replace("value", TITLE, "").alias("old"), F.regexp_replace("new", TITLE, "").alias("new")))
    # written, so that the join below has a shuffle of its own, which adaptive execution can split where a text has many copies
    found = keep(found.groupBy("tk", "tl").agg(F.sort_array(F.collect_list(F.struct("i", "new"))).alias("found"), F.collect_set(person).alias("persons"), F.count("kind").alias("n")))
    # one pattern of all of a text's persons, the longest names first
    of_length = F.sort_array(F.transform("persons", lambda x: F.struct((-F.length(x["old"])).alias("n"), x["old"].alias("old"), x["new"].alias("new"))))
    some_one = F.concat(F.lit(r"(?<!\p{L})(?:\Q"), F.array_join(F.transform(of_length, lambda x: x["old"]), r"\E|\Q"), F.lit(r"\E)(?!\p{L})"))
    put_in = lambda w: F.coalesce(F.get(F.filter("persons", lambda x: x["old"] == w), F.lit(0))["new"], F.lit(""))
    untitled = lambda gap: F.array_join(F.zip_with(F.split(gap, F.col("pattern"), -1), F.regexp_extract_all(gap, F.col("pattern"), F.lit(0)), lambda t, w: F.concat(t, put_in(w))), "")
    gaps = F.split(F.col("text"), ANY, -1)
    put = F.array_join(F.zip_with(gaps, F.col("found"), lambda g, x: F.concat(F.when(F.size("persons") > 0, untitled(g)).otherwise(g), F.coalesce(x["new"], F.lit("")))), "")
    some = flat.where(has).join(found.withColumn("pattern", some_one), ["tk", "tl"])
    out = lambda n, t: {"n_entities": n.cast("long"), "surrogate_text": t}
    return leave(some, names, out(F.col("n"), put)).unionByName(leave(flat.where(~has), names, out(F.lit(0), F.col("text"))))
