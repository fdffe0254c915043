"""Onboarding of new tables from their DDL: facts are read from the DDL, a draft adds judgment, a person decides."""
