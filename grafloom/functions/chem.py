"""Functions of molecular structure. They need the optional package RDKit; without it a call says so."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _rdkit():
    try:
        from rdkit import Chem
        from rdkit.Chem import Descriptors, MACCSkeys, rdMolDescriptors
    except ImportError as e:
        raise RuntimeError("functions of molecular structure need the package rdkit") from e
    return Chem, Descriptors, MACCSkeys, rdMolDescriptors


def _by_smiles(make: Callable, kind: T.DataType):
    """A pandas function of SMILES; null for null or unreadable ones."""

    def run(smiles: pd.Series) -> pd.Series:
        modules = _rdkit()
        out = []
        for s in smiles:
            mol = modules[0].MolFromSmiles(s) if isinstance(s, str) and s else None
            out.append(None if mol is None else make(mol, *modules))
        return pd.Series(out, dtype=object)

    run.__annotations__ = {"smiles": pd.Series, "return": pd.Series}
    return F.pandas_udf(kind)(run)


def canonical_smiles(largest_fragment: bool = False):
    def make(mol, chem, *_):
        if largest_fragment:
            mol = max(chem.GetMolFrags(mol, asMols=True), key=lambda m: m.GetNumHeavyAtoms())
        return chem.MolToSmiles(mol)

    return _by_smiles(make, T.StringType())


def inchikey():
    return _by_smiles(lambda mol, chem, *_: chem.MolToInchiKey(mol) or None, T.StringType())


def molecular_formula():
    return _by_smiles(lambda mol, _c, _d, _k, r: r.CalcMolFormula(mol), T.StringType())


def maccs(bits: int = 167):
    """The MACCS keys as 0 and 1; of 166 without the unused first."""
    return _by_smiles(lambda mol, _c, _d, k, _r: k.GenMACCSKeys(mol).ToBitString()[167 - bits :], T.StringType())


# The deprecated classes by what a structure must have.
CLASS_RULES = {
    "Polyphenol": "rings >= 2 and hydroxyls >= 2",
    "Carotenoid": "carbons >= 30 and double_bonds >= 5",
    "Phytosterol": "rings >= 4 and hydroxyls >= 1",
    "Saponin": "carbons >= 40 and oxygens >= 5",
    "Polysaccharide": "mw > 500 and oxygens > 10",
    "DietaryFiber": "carbons > 20 and oxygens > 15",
    "Isoprenoid": "contains(smiles, 'C=C') and carbons % 5 = 0",
}


def heuristic_classes() -> Column:
    """The deprecated classes of a row (smiles, mw, rings, hydroxyls, carbons, oxygens, double_bonds); Unknown where none holds or the structure is unreadable."""
    found = F.array_compact(F.array(*[F.when(F.expr(rule), F.lit(name)) for name, rule in CLASS_RULES.items()]))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("Unknown")))


def class_features(df: DataFrame, smiles: str) -> DataFrame:
    """df with the columns that heuristic_classes asks for; null for unreadable structures."""
    counts = T.StructType([T.StructField("mw", T.DoubleType()), *(T.StructField(n, T.IntegerType()) for n in ("rings", "hydroxyls", "carbons", "oxygens", "double_bonds"))])

    def make(mol, chem, descriptors_, *_):
        symbols = [a.GetSymbol() for a in mol.GetAtoms()]
        matches = lambda pattern: len(mol.GetSubstructMatches(chem.MolFromSmarts(pattern)))
        return {"mw": descriptors_.MolWt(mol), "rings": descriptors_.RingCount(mol), "hydroxyls": matches("[OH]"), "carbons": symbols.count("C"), "oxygens": symbols.count("O"), "double_bonds": matches("C=C")}

    one = _by_smiles(lambda *a: str(make(*a)).replace("'", '"'), T.StringType())
    return df.withColumn("__f", F.from_json(one(F.col(smiles)), counts)).select("*", "__f.*").drop("__f")


# Descriptors by name, with the type of their value.
DESCRIPTORS = {
    "mw": "double", "exact_mw": "double", "logp": "double", "tpsa": "double", "qed": "double", "fraction_csp3": "double",
    "hbd": "long", "hba": "long", "rotatable_bonds": "long", "rings": "long", "aromatic_rings": "long", "heavy_atoms": "long", "charge": "long", "stereocentres": "long", "ro5_violations": "long",
}


def descriptors(df: DataFrame, smiles: str) -> DataFrame:
    """df with the descriptors of its column of SMILES, null where it is unreadable."""

    def make(mol, chem, d, _k, r):
        from rdkit.Chem import QED

        x = {"mw": round(d.MolWt(mol), 3), "exact_mw": round(d.ExactMolWt(mol), 5), "logp": round(d.MolLogP(mol), 3), "tpsa": round(d.TPSA(mol), 2), "qed": round(QED.qed(mol), 3), "fraction_csp3": round(r.CalcFractionCSP3(mol), 3)}
        x |= {"hbd": r.CalcNumHBD(mol), "hba": r.CalcNumHBA(mol), "rotatable_bonds": r.CalcNumRotatableBonds(mol), "rings": r.CalcNumRings(mol), "aromatic_rings": r.CalcNumAromaticRings(mol), "heavy_atoms": mol.GetNumHeavyAtoms(), "charge": chem.GetFormalCharge(mol), "stereocentres": len(chem.FindMolChiralCenters(mol, includeUnassigned=True))}
        return x | {"ro5_violations": (x["mw"] > 500) + (x["logp"] > 5) + (x["hbd"] > 5) + (x["hba"] > 10)}

    def run(values: pd.Series) -> pd.DataFrame:
        modules, rows = _rdkit(), []
        for s in values:
            mol = modules[0].MolFromSmiles(s) if isinstance(s, str) and s else None
            rows.append({} if mol is None else make(mol, *modules))
        return pd.DataFrame(rows, columns=list(DESCRIPTORS))

    kinds = {"double": T.DoubleType(), "long": T.LongType()}
    run.__annotations__ = {"values": pd.Series, "return": pd.DataFrame}
    calc = F.pandas_udf(T.StructType([T.StructField(k, kinds[v]) for k, v in DESCRIPTORS.items()]))(run)
    return df.withColumn("__d", calc(smiles)).select(*df.columns, "__d.*")
