"""Relational operators on features: intervals, hierarchy, comparison, ORFs, function, splicing, submission."""
