"""Whole-relation operators: staging cleaners, marts, weekly KPIs, checks, serving."""
