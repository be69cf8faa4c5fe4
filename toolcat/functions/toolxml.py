"""Tool XML, sidecar YAML and workflow archives: the three formats for which Spark has no reader."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import functions as F

from toolcat import schemas

#: A document that tokens make longer than this many characters stays as it was.
LONGEST = 1 << 24


def _root(text: str | None) -> ElementTree.Element | None:
    try:
        return ElementTree.fromstring(text) if text else None
    except ElementTree.ParseError:
        return None


@F.pandas_udf(schemas.xml_head)
def xml_head(content: pd.Series) -> pd.DataFrame:
    """Macro imports and token definitions of any document, in the order in which names first come, each with its
    last value; ``error`` where it is no XML."""
    rows = []
    for text in content:
        root = _root(text)
        if root is None:
            rows.append(([], [], "not_xml"))
            continue
        imports = [(e.text or "").strip() for m in root.iter("macros") for e in m.findall("import")]
        tokens = {e.get("name"): e.text or "" for e in root.iter("token") if e.get("name")}
        rows.append((imports, [{"name": k, "value": v} for k, v in tokens.items()], None))
    return pd.DataFrame(rows, columns=["imports", "tokens", "error"])


xml_head = xml_head.asNondeterministic()  # so that it is evaluated once where its fields are used several times


def cyclic(tokens: dict[str, str]) -> set[str]:
    """Names that lie in a strongly connected component of the graph which leads from each token to the names that its
    text holds: those that lead back to themselves."""
    held = {name: [other for other in tokens if other in value] for name, value in tokens.items() if name}
    found = set()
    for name in held:
        seen, todo = set(), list(held[name])
        while todo and name not in seen:
            other = todo.pop()
            if other not in seen:
                seen.add(other)
                todo += held.get(other, [])
        if name in seen:
            found.add(name)
    return found


def substitute(text: str, tokens: dict[str, str]) -> tuple[str, str | None]:
    """Replace all tokens one after the other, in their order of definition, again and again until a pass changes
    nothing. ``token_breaks_xml``: a pass made the document invalid, so the one before it stays.

    Where tokens lead to others but never back, each pass settles one more step, so as many passes as there are tokens
    suffice; as many also bring a cycle that doesn't grow back to where it stands still, if it does. What still changes
    then is a cycle (``token_cycle``): its tokens stay as they are and the others are replaced. Only names that come
    about where two pieces meet can take more passes without a cycle; they go on while the document doesn't grow."""
    tokens = {name: value for name, value in tokens.items() if name}
    before, passes, growth, seen = text, 0, 0, set()

    def without_cycles() -> tuple[str, str] | None:
        loops = cyclic(tokens)
        if not loops:
            return None
        found, note = substitute(before, {k: v for k, v in tokens.items() if k not in loops})
        return found, note or "token_cycle"

    while True:
        new = text
        for name, value in tokens.items():
            if len(new) + new.count(name) * (len(value) - len(name)) > LONGEST:
                return without_cycles() or (before, "token_too_long")
            new = new.replace(name, value)
        if new == text:
            return text, None
        if _root(new) is None:
            return text, "token_breaks_xml"
        growth, text, passes = growth + (len(new) > len(text)), new, passes + 1
        if passes <= len(tokens) + 1:
            continue
        if found := without_cycles():
            return found
        if text in seen or growth > 2 * len(tokens) + 2:
            return before, "token_cycle"
        seen.add(text)


def _below(root: ElementTree.Element, group: str, tag: str) -> list[ElementTree.Element]:
    seen: dict[int, ElementTree.Element] = {}
    for g in root.iter(group):
        if g is not root:
            seen |= {id(e): e for e in g.iter() if e is not g and isinstance(e.tag, str) and e.tag.lower() == tag}
    return list(seen.values())


@F.pandas_udf(schemas.tool_xml)
def parse_tool(content: pd.Series, tokens: pd.Series) -> pd.DataFrame:
    """A tool's description after token substitution (``tokens``: in order of definition); null fields and ``error`` where the document
    is no XML or no tool."""
    rows = []
    for text, named in zip(content, tokens, strict=True):
        root = _root(text)
        if root is None or root.tag != "tool":
            rows.append((None,) * 7 + ("not_xml" if root is None else "not_a_tool",))
            continue
        whole, note = substitute(text, {t["name"]: t["value"] for t in (named if named is not None else ())})
        root = root if whole == text else _root(whole)
        inputs = [
            {"name": e.get("name"), "tag": e.tag, "type": e.get("type"), "format": e.get("format"), "label": e.get("label")}
            for e in _below(root, "inputs", "param") if e.get("type") != "select"
        ]
        outputs = [
            {"name": e.get("name"), "tag": e.tag, "type": "data", "format": e.get("format"), "label": e.get("label")}
            for e in _below(root, "outputs", "data")
        ]
        rows.append((root.get("id"), root.get("name"), root.get("version"), root.findtext("description") or "", root.findtext("help") or "", inputs, outputs, note))
    return pd.DataFrame(rows, columns=[f.name for f in schemas.tool_xml])


parse_tool = parse_tool.asNondeterministic()


@F.pandas_udf(schemas.sidecar)
def parse_sidecar(content: pd.Series) -> pd.DataFrame:
    """Owner, descriptions and categories of a sidecar; nulls where it is empty or no mapping."""
    import yaml

    loader, rows = getattr(yaml, "CSafeLoader", yaml.SafeLoader), []
    for text in content:
        try:
            found = yaml.load(text or "", loader) or {}
        except yaml.YAMLError:
            found = {}
        found = found if isinstance(found, dict) else {}
        categories = found.get("categories") or []
        categories = [str(c) for c in categories] if isinstance(categories, list) else []
        texts = [None if found.get(n) is None else str(found[n]) for n in ("owner", "description", "long_description")]
        rows.append((*texts, categories))
    return pd.DataFrame(rows, columns=["owner", "description", "long_description", "categories"])


def first_workflow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each archive (``path, content``) the first entry, in archive order, that ends in ``.ga``."""
    for batch in batches:
        rows = []
        for path, content in zip(batch["path"], batch["content"], strict=True):
            text = entry = position = error = None
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    found = [(i, n) for i, n in enumerate(z.namelist()) if n.endswith(".ga")]
                    if found:
                        position, entry = found[0]
                        text = z.read(entry).decode()
                    else:
                        error = "no workflow in archive"
            except (zipfile.BadZipFile, UnicodeDecodeError, OSError, EOFError) as e:
                error = f"{type(e).__name__}"
            rows.append((path, entry, position, text, error))
        yield pd.DataFrame(rows, columns=["path", "entry", "position", "ga", "error"]).astype({"position": "Int32"})
