"""Readers and writers for the text formats of genome sites, intervals, alignments and trees."""
