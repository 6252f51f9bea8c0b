"""DataFrame-level operators: profiles, limits, dictionary match, links, enrichment."""
