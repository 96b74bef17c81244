"""Names and paths as column expressions, and glob patterns as regular expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Characters a path part must not hold, and what stands in for each.
UNSAFE_CHARACTERS = '/\\:*?"<>|'
SAFE_CHARACTER = "_"
DEFAULT_DATABASE = "default"


def path_safe(name: Column) -> Column:
    return F.translate(name, UNSAFE_CHARACTERS, SAFE_CHARACTER * len(UNSAFE_CHARACTERS))


def path_safe_text(name: str) -> str:
    return name.translate(str.maketrans(dict.fromkeys(UNSAFE_CHARACTERS, SAFE_CHARACTER)))


def table_path(database: Column, schema: Column, table: Column) -> Column:
    """``database/schema/table`` without the parts that are NULL."""
    return F.concat_ws("/", path_safe(database), path_safe(schema), path_safe(table))


def fill_template(template: str, **values: Column) -> Column:
    """Replace ``{name}`` by the path-safe value; names without a value stay."""
    filled = F.lit(template)
    for name, value in values.items():
        filled = F.replace(filled, F.lit("{" + name + "}"), path_safe(value))
    return filled


def table_target(template: str, database: Column, schema: Column, table: Column) -> Column:
    return fill_template(
        template,
        database=F.coalesce(database, F.lit(DEFAULT_DATABASE)),
        schema=schema,
        table=table,
    )


def file_template(target: str) -> tuple[str, str | None]:
    """(folder, file name) of a target that ends in a file name with ``{file_index}``."""
    folder, _, name = target.rpartition("/")
    if folder and "{file_index}" in name:
        return folder, name
    return target, None


def slice_target(template: str, slice_id: str) -> str:
    """Folder of one slice: where the template puts it, else a subfolder."""
    safe = path_safe_text(slice_id)
    if "{partition}" in template:
        return template.replace("{partition}", safe)
    return f"{template.rstrip('/')}/{safe}"


def single_target(template: str, slice_id: str = "single") -> str:
    """Folder of a task that is exported whole."""
    return template.replace("{partition}", path_safe_text(slice_id))


def glob_regex(pattern: str) -> str:
    """Anchored regular expression of a glob with ``* ? [..] [!..] {a,b}`` and ``\\``.

    ``*`` and ``?`` match any character, dots included.
    """
    parts: list[str] = []
    depth = 0
    rest = pattern
    while rest:
        char, rest = rest[0], rest[1:]
        if char == "*":
            parts.append(".*")
        elif char == "?":
            parts.append(".")
        elif char == "\\":
            if not rest:
                raise ValueError(f"bad pattern {pattern!r}: nothing to escape")
            parts.append(re.escape(rest[0]))
            rest = rest[1:]
        elif char == "[":
            group = re.match(r"(!|\^)?(\]?[^\]]*)\]", rest)
            if not group or not group.group(2):
                raise ValueError(f"bad pattern {pattern!r}: unclosed [")
            body = re.sub(r"([\\\[\]&^])", r"\\\1", group.group(2))
            parts.append(f"[{'^' if group.group(1) else ''}{body}]")
            rest = rest[group.end() :]
        elif char == "{":
            depth += 1
            parts.append("(?:")
        elif char == "}" and depth:
            depth -= 1
            parts.append(")")
        elif char == "}":
            raise ValueError(f"bad pattern {pattern!r}: unopened }}")
        elif char == "," and depth:
            parts.append("|")
        else:
            parts.append(re.escape(char))
    if depth:
        raise ValueError(f"bad pattern {pattern!r}: unclosed {{")
    return f"(?s)^(?:{''.join(parts)})$"


def glob_match(name: Column, include: list[str], exclude: list[str]) -> Column:
    """True where any include pattern matches (or none is given) and no exclude does."""

    def any_of(patterns: list[str]) -> Column:
        matches = F.lit(False)
        for pattern in patterns:
            matches = matches | name.rlike(glob_regex(pattern))
        return matches

    wanted = any_of(include) if include else F.lit(True)
    return wanted & ~any_of(exclude)
