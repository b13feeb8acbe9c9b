"""Run configuration from files and the command line."""

from __future__ import annotations

import argparse
import json
import logging
import os

log = logging.getLogger(__name__)


def _scalar(text: str):
    text = text.strip()
    if text[:1] in "\"'" and text[-1:] == text[:1] and len(text) > 1:
        return text[1:-1]
    text = text.split(" #")[0].strip()
    if text.startswith("[") and text.endswith("]"):
        return [_scalar(x) for x in text[1:-1].split(",") if x.strip()]
    known = {"": None, "null": None, "~": None, "true": True, "false": False}
    if text.lower() in known:
        return known[text.lower()]
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text


def _flat_yaml(text: str) -> dict:
    """Keys with scalars or lists of scalars, at most one level deep: enough for a run configuration."""
    out: dict = {}
    section, key = out, None
    for line in text.splitlines():
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        indent, body = len(line) - len(line.lstrip()), line.strip()
        if body.startswith("- "):
            holder, name = key
            if not isinstance(holder[name], list):
                holder[name] = []
            holder[name].append(_scalar(body[2:]))
            continue
        name, _, value = body.partition(":")
        if indent and key and not isinstance(key[0][key[1]], dict) and key[0] is out:
            out[key[1]] = section = {}
        elif not indent:
            section = out
        section[name.strip()] = _scalar(value)
        key = (section, name.strip())
    return out


def load_config(path: str | None) -> dict:
    """A JSON or YAML file whose root is a mapping, perhaps with all of it under a section's name."""
    if path is None:
        return {}
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    suffix = os.path.splitext(path)[1].lower()
    with open(path, encoding="utf8") as f:
        text = f.read()
    if suffix == ".json":
        found = json.loads(text)
    elif suffix in (".yaml", ".yml"):
        try:
            import yaml

            found = yaml.safe_load(text)
        except ImportError:
            found = _flat_yaml(text)
    else:
        raise ValueError(f"a configuration is a .json, .yaml or .yml file, not {suffix or 'one without suffix'}")
    found = {} if found is None else found
    if not isinstance(found, dict):
        raise ValueError("the root of a configuration is a mapping")
    values = list(found.values())
    return values[0] if len(values) == 1 and isinstance(values[0], dict) else found


def merge_config(args: argparse.Namespace, parser: argparse.ArgumentParser, config: dict) -> argparse.Namespace:
    """Fill arguments that are None or equal to their default from the file; unknown keys are skipped with a warning.

    An argument given explicitly with its default value can't be told from one not given.
    """
    for key, value in config.items():
        if not hasattr(args, key):
            log.warning("unknown key in the configuration: %s", key)
        elif getattr(args, key) is None or getattr(args, key) == parser.get_default(key):
            setattr(args, key, value)
    return args
