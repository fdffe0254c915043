"""python -m tidemark.onboarding --ddl table.sql --source db2_core

Writes a proposal for a person to review. Exit code 1 if something blocks it (the file is written all the same).
"""

from __future__ import annotations

import argparse
from pathlib import Path

import yaml

from tidemark import config
from tidemark.onboarding import ddl as ddl_reader
from tidemark.onboarding.draft import Client, draft, prompt
from tidemark.onboarding.review import proposal, validate


def main(argv: list[str] | None = None, client: Client | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemark.onboarding", description=__doc__)
    p.add_argument("--ddl", required=True, type=Path, help="file with one CREATE TABLE")
    p.add_argument("--source", required=True, help="a source of the configuration")
    p.add_argument("--config", type=Path, default=config.DEFAULT)
    p.add_argument("--out", type=Path, default=config.DEFAULT.parent / "proposals")
    p.add_argument("--dry-run", action="store_true", help="print the prompt and stop")
    a = p.parse_args(argv)
    cfg = config.load(a.config)
    if a.source not in cfg["sources"]:
        p.error(f"no source {a.source!r}; there are {', '.join(cfg['sources'])}")
    kind, text = cfg["sources"][a.source]["type"], a.ddl.read_text(encoding="utf-8")
    table = ddl_reader.parse(text)
    if a.dry_run:
        print(prompt(table, text, kind, cfg))
        return 0
    if client is None:
        p.error("no model client is configured; give main() one, or use --dry-run")
    made, provenance = draft(client, table, text, kind, cfg)
    findings = validate(made, table, kind, cfg)
    out = proposal(made, findings, table, text, a.source, kind, provenance)
    a.out.mkdir(parents=True, exist_ok=True)
    path = a.out / f"{a.source}__{table.qualified}.yml"
    path.write_text(yaml.safe_dump(out, sort_keys=False, allow_unicode=True, width=100), encoding="utf-8")
    print(f"{out['status']}: {path}")
    for f in findings:
        print(f"  {f.level}: {f.message}")
    for n in made["review_notes"]:
        print(f"  model, {n['severity']}: {n['note']}")
    return int(out["status"] != "ready_for_review")
