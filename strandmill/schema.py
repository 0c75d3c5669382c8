"""Column sets of the structural-variant tables; every operator names the ones it reads."""

from __future__ import annotations

ALIGNMENT = "qname string, flag int, rname string, pos long, mapq int, cigar string, seq string, sa string"
SIGNAL = "chrom string, query_name string, start long, stop long, sv_len long, maq int, svid string, sv_type string, seq string"
COVERAGE = "query_chrom string, flag int, chrom string, start long, stop long, maq int, cigar string"
DEPTH = "chrom string, size long, mapped long, depth double"
BREAKPOINT = "query_name string, flag int, chrom string, pos long"
CANDIDATE = "chrom string, start long, stop long, sv_len long, svid string, sv_type string, seq string, maq int, cluster_size long, sv_rate double"
GENOTYPE = "chrom string, start long, stop long, target_size long, query_size long, sample string, gt string, reads long, support string"
VCF = "chrom string, pos long, id string, ref string, alt string, qual string, filter string, info string, format string"
GFF = "chrom string, source string, feature string, start long, stop long, score string, strand string, phase string, attrs string"
SNP = "chrom string, pos long, con string, mut string, con_n long, mut_n long, con_freq double, mut_freq double"
ENZYME = "name string, site string, cut string"
SV_TYPES = ("DEL", "INS", "INV", "DUP", "TRA")
