"""Molecule kernels: connection tables, geometry, fingerprints, scaffolds, torsion matches."""
