"""Readers and writers of the formats around an annotation: GFF3/GTF, FASTA, junctions, KO lists, logs."""
