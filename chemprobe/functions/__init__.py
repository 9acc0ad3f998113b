"""Column builders: byte codes, bit queries, sequences, CIGAR strings, statistics."""
