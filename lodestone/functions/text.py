"""Text: money, links, splits, templates, commands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def money(copper: Column) -> Column:
    """Gold, then silver only below 50 gold, then copper only below 10 gold; parts of 0 are left out."""
    gold, silver, rest = F.floor(copper / 10000), F.floor(copper / 100) % 100, copper % 100
    parts = [F.when(gold > 0, F.concat(gold.cast("string"), F.lit("g"))), F.when((silver > 0) & (gold < 50), F.concat(silver.cast("string"), F.lit("s"))), F.when((rest > 0) & (gold < 10), F.concat(rest.cast("string"), F.lit("c")))]
    joined = F.concat_ws(" ", *parts)
    return F.when(joined == "", "0c").otherwise(joined)


def copper(text: Column) -> Column:
    """X9: '12g3s4c' in copper, up to the first space; any other character gives 0."""
    head = F.split(text, " ")[0]
    part = lambda unit: F.coalesce(F.nullif(F.regexp_extract(head, rf"(\d+){unit}", 1), F.lit("")).cast("long"), F.lit(0))
    return F.when(head.rlike(r"^(\d+g)?(\d+s)?(\d+c)?$"), part("g") * 10000 + part("s") * 100 + part("c")).otherwise(F.lit(0).cast("long"))


def split_keep_inner(text: Column, by: str) -> Column:
    """Split by a character; inner empty parts stay, one empty part at the end goes."""
    parts = F.split(text, f"\\Q{by}\\E", -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def split_drop_empty(text: Column, any_of: str) -> Column:
    """Split by any of the characters; no empty parts."""
    return F.filter(F.split(text, f"[{any_of}]"), lambda p: p != "")


def filled(template: Column, values: dict[str, Column]) -> Column:
    """Placeholders replaced in the order of their names."""
    for name in sorted(values):
        template = F.replace(template, F.lit(name), values[name])
    return template


def erased(text: Column, part: str) -> Column:
    """All `part` taken out, again and again until none is left (what a removal brings together is taken out too). Every
    round that changes a text shortens it by a part at least, so as many rounds as parts fit in it are enough."""
    rounds = F.sequence(F.lit(0), F.floor(F.length(text) / len(part)).cast("int"))
    return F.aggregate(rounds, text, lambda t, _: F.when(F.contains(t, F.lit(part)), F.replace(t, F.lit(part), F.lit(""))).otherwise(t))


def linked_ids(text: Column, tag: str) -> Column:
    """X11: the distinct ids behind a tag."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(rf"{tag}(\d+)"), F.lit(1)))


def localised(texts: list[Column]) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts])


def routed(messages: DataFrame, commands: DataFrame, text: str, command: str) -> DataFrame:
    """Each message with its longest prefix of whole words that is a command, and the rest as parameter. Prefixes are
    tried up to the words of the longest command."""
    most = commands.agg(F.max(F.size(F.split(command, " ")))).first()[0] or 0
    words = F.split(F.col(text), " ")
    tries = F.explode(F.sequence(F.lit(1), F.least(F.size(words), F.lit(max(1, most)))))
    prefixes = messages.withColumn("_row", F.monotonically_increasing_id()).withColumn("_n", tries).withColumn(command, F.array_join(F.slice(words, F.lit(1), F.col("_n")), " "))
    hit = prefixes.join(commands.select(command).distinct(), command)
    best = hit.groupBy("_row").agg(F.max_by(F.struct(*messages.columns, command), "_n").alias("_b")).select("_b.*")
    return best.withColumn("param", F.ltrim(F.expr(f"substring({text}, length({command}) + 1)")))


def item_link(text: Column) -> Column:
    """struct(item, property) of the first item link: the id behind 'Hitem:' and the sixth parameter behind it, parted by
    colons (the last one ends at '|h', or is none); 0 for what is no number; null item without a link, null property before the sixth."""
    tail = F.when(F.contains(text, F.lit("Hitem:")), F.regexp_replace(text, r"(?s)^.*?Hitem:", ""))
    parts = F.split(tail, ":", -1)
    whole = F.slice(parts, 2, F.greatest(F.lit(0), F.size(parts) - 2))
    last = F.when((F.size(parts) > 1) & F.element_at(parts, -1).contains("|h"), F.array(F.substring_index(F.element_at(parts, -1), "|h", 1))).otherwise(F.array().cast("array<string>"))
    params = F.concat(whole, last)
    return F.struct(F.when(F.size(parts) > 1, number(parts[0])).alias("item"), F.when(F.size(params) >= 6, number(F.get(params, F.lit(5)))).alias("property"))


def number(text: Column) -> Column:
    """The whole number that a text begins with, behind white space; 0 if there is none."""
    return F.coalesce(F.nullif(F.regexp_extract(text, r"^\s*([+-]?\d+)", 1), F.lit("")).try_cast("long"), F.lit(0).cast("long"))


def rule(line: Column, normal: float = 10.0) -> Column:
    """struct(trigger, actions) of 'trigger>action!relevance,action': actions is an array of (action, rel), `normal` where
    none is given; null for a line that has not one '>' or has an action without a name or with two '!'."""
    sides = split_keep_inner(line, ">")
    said = F.transform(split_keep_inner(F.get(sides, F.lit(1)), ","), lambda a: split_keep_inner(a, "!"))
    bad = F.exists(said, lambda a: (F.size(a) == 0) | (F.size(a) > 2) | (F.get(a, F.lit(0)) == ""))
    rel = lambda a: F.coalesce(F.nullif(F.regexp_extract(F.get(a, F.lit(1)), r"^\s*([+-]?\d*\.?\d+)", 1), F.lit("")).cast("double"), F.lit(0.0))
    actions = F.transform(said, lambda a: F.struct(F.get(a, F.lit(0)).alias("action"), F.when(F.size(a) == 1, F.lit(normal)).otherwise(rel(a)).alias("rel")))
    return F.when((F.size(sides) == 2) & ~bad, F.struct(sides[0].alias("trigger"), actions.alias("actions")))


def inserted_rows(sql: str, names: str) -> list[tuple]:
    """The rows of a multi-row INSERT ... VALUES: numbers, quoted texts (a doubled quote or a backslash stands for the sign behind it) and NULL."""
    import re

    body = sql[sql.upper().index("VALUES") + 6 :]
    token = re.compile(r"\s*(?:'((?:[^'\\]|''|\\.)*)'|(NULL)|([+-]?\d+\.\d*)|([+-]?\d+))\s*([,)])", re.S)
    rows, at = [], body.find("(")
    while at >= 0:
        row, at = [], at + 1
        while True:
            m = token.match(body, at)
            if not m:
                raise ValueError(f"no value of {names} at {body[at : at + 20]!r}")
            row.append(re.sub(r"''|\\(.)", lambda x: x[1] or "'", m[1]) if m[1] is not None else None if m[2] else float(m[3]) if m[3] else int(m[4]))
            at = m.end()
            if m[5] == ")":
                break
        rows.append(tuple(row))
        at = body.find("(", at)
    return rows


def deltas(text: Column) -> Column:
    """Array of (sign, name) of '+a,-b,~c'; parts without a sign are left out."""
    parts = F.filter(F.split(text, ","), lambda p: F.substring(p, 1, 1).isin("+", "-", "~") & (F.length(p) > 1))
    return F.transform(parts, lambda p: F.struct(F.substring(p, 1, 1).alias("sign"), p.substr(F.lit(2), F.length(p)).alias("name")))


def selected(message: Column, flags: dict[str, Column], level: Column, numbered: dict[str, Column], named: Column, names: tuple[str, ...]) -> Column:
    """a message behind the selector it begins with, '' where that does not fit: @flag by a condition, @number by a value,
    @name by a name. @from-to is the level's; a level outside lets the whole message pass, as it came. Others pass as they are."""
    tag = F.lower(F.substring_index(message, " ", 1))
    rest = F.when(F.contains(message, F.lit(" ")), F.substr(message, F.instr(message, F.lit(" ")) + 1)).otherwise("")
    out = F.when(tag.rlike("^@[0-9]+-[0-9]+$"), F.when(level.between(F.regexp_extract(tag, "^@([0-9]+)", 1).try_cast("long"), F.regexp_extract(tag, "-([0-9]+)$", 1).try_cast("long")), rest).otherwise(message))
    for name, fits in flags.items():
        out = out.when(tag == name, F.when(fits, rest).otherwise(""))
    for name, value in numbered.items():
        out = out.when(tag.rlike(f"^{name}[0-9]+$"), F.when(F.regexp_extract(tag, "([0-9]+)$", 1).try_cast("long") == value, rest).otherwise(""))
    for name in names:
        out = out.when(tag == f"@{name}", F.when(named == name, rest).otherwise(""))
    return out.otherwise(message)


def reply(command: Column, told: dict[str, Column]) -> Column:
    """What a remote command is answered: its name and the snapshot's value, or that the request is invalid."""
    out = None
    for name, value in told.items():
        said = F.concat(F.lit(f"{name} "), value)
        out = F.when(command == name, said) if out is None else out.when(command == name, said)
    return out.otherwise("invalid request")


def wkt(points: Column, shape: str) -> Column:
    """POINT, MULTIPOINT, LINESTRING or POLYGON (closed) of an array of structs with x and y; of a POINT the first."""
    pair = lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))
    listed = lambda a: F.array_join(F.transform(a, pair), ",")
    if shape == "POINT":
        return F.concat(F.lit("POINT("), pair(points[0]), F.lit(")"))
    if shape == "POLYGON":
        return F.concat(F.lit("POLYGON(("), listed(F.concat(points, F.slice(points, 1, 1))), F.lit("))"))
    return F.concat(F.lit(f"{shape}("), listed(points), F.lit(")"))


def generated_name(key: Column, forms: list[str], letters: dict[str, str], rules: list[tuple[str, str]]) -> Column:
    """A name for each key: a form, its categories replaced by letters of theirs, then rules applied one after the
    other, each until it no longer applies; the first letter is a capital. Choices are hashes of the key, so names stay."""
    roll = lambda at, n: F.conv(F.substring(F.md5(F.concat(F.lit(f"{at}:"), key.cast("string"))), 1, 8), 16, 10).cast("long") % n
    form = F.element_at(F.array(*[F.lit(f) for f in forms]), (roll("form", len(forms)) + 1).cast("int"))
    parts = []
    for i in range(max(map(len, forms))):
        sign = F.substring(form, i + 1, 1)
        letter = F.lit("")
        for category, of in letters.items():
            letter = F.when(sign == category, F.substr(F.lit(of), (roll(i, len(of)) + 1).cast("int"), F.lit(1))).otherwise(letter)
        parts.append(letter)
    name = F.concat(*parts)
    for old, new in rules:
        if old in new:
            raise ValueError(f"the rule {old} -> {new} never ends")
        name = _rewritten(name, old, new)
    return F.initcap(name)


def _rewritten(name: Column, old: str, new: str) -> Column:
    """name with `old` replaced by `new` until it no longer occurs."""
    return F.aggregate(F.sequence(F.lit(0), F.length(name)), name, lambda t, _: F.when(F.contains(t, F.lit(old)), F.replace(t, F.lit(old), F.lit(new))).otherwise(t))
