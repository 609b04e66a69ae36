"""Role views (G3, G4).  The role is a job parameter; the masking is a
projection and the tenant filter a predicate, so both stay in the plan and
are pushed down with everything else."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.masking import PRIVILEGED_ROLES, mask_date, mask_string

# --- fixed values: masked columns of dim_client and their kind -------------
DIM_CLIENT_POLICY = {
    "client_id_number": "string",
    "client_first_name": "string",
    "client_surname": "string",
    "client_full_name": "string",
    "birth_date": "date",
}


def masked_view(df: DataFrame, role: str, policy_map: dict[str, str] = DIM_CLIENT_POLICY) -> DataFrame:
    """Apply the column policies for ``role``; other columns pass."""
    cols = []
    for c in df.columns:
        kind = policy_map.get(c)
        if kind == "string":
            cols.append(mask_string(c, role).alias(c))
        elif kind == "date":
            cols.append(mask_date(c, role).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


#: Expressions that tell no value of their input apart from it being there,
#: and the digests that hashed keys are made of, which stay joinable.
_CLOSED = {"Count", "IsNull", "IsNotNull", "Md5", "Sha2"}


def _seq(items) -> list:
    return [items.apply(i) for i in range(items.size())]


def derived_columns(df: DataFrame, names) -> list[str]:
    """Output columns of ``df`` computed from a column named in ``names``, at
    any depth of its analysed plan: through renames, expressions, aggregates,
    windows, joins, unions and subqueries.  Counts, null tests and
    digests do not count as derived; what a Python function puts out does."""
    names, masked = set(names), set()
    kind = lambda node: node.getClass().getSimpleName().rstrip("$")
    number = lambda attribute: attribute.exprId().id()

    def shows(e) -> bool:
        if kind(e) in _CLOSED:
            return False
        if kind(e) == "AttributeReference":
            return number(e) in masked
        if kind(e) == "WindowExpression":
            return shows(e.windowFunction())
        if kind(e) in ("ScalarSubquery", "LateralSubquery"):
            visit(e.plan())
            return any(number(a) in masked for a in _seq(e.plan().output()))
        return any([shows(c) for c in _seq(e.children())])

    def visit(plan) -> None:
        children, output = _seq(plan.children()), _seq(plan.output())
        for child in children:
            visit(child)
        masked.update(number(a) for a in output if a.name() in names)
        below = [_seq(c.output()) for c in children]
        made = set()
        for e in _seq(plan.expressions()):
            if kind(e) == "Alias":
                made.add(number(e))
                if shows(e.child()):
                    masked.add(number(e))
        if kind(plan) == "Union":
            masked.update(number(a) for i, a in enumerate(output) if any(number(b[i]) in masked for b in below))
        elif children:
            passed = {number(a) for b in below for a in b} | made
            if any(number(a) in masked for b in below for a in b):
                source = shows(plan.generator()) if kind(plan) == "Generate" else True
                masked.update(number(a) for a in output if source and number(a) not in passed)

    plan = df._jdf.queryExecution().analyzed()
    visit(plan)
    return [a.name() for a in _seq(plan.output()) if number(a) in masked]


def masked_lineage(df: DataFrame, role: str, policy_map: dict[str, str] = DIM_CLIENT_POLICY) -> DataFrame:
    """G3 for tables and views built over masked columns: every column that
    derives from one is masked too, by its type (text by the string mask,
    dates by their year, anything else is null)."""
    if role in PRIVILEGED_ROLES:
        return df
    derived = set(derived_columns(df, policy_map))
    cols = []
    for field in df.schema.fields:
        c, type_name = F.col(f"`{field.name}`"), field.dataType.typeName()
        if field.name not in derived:
            cols.append(c)
        elif policy_map.get(field.name) == "string" or type_name == "string":
            cols.append(mask_string(c, role).alias(field.name))
        elif type_name == "date":
            cols.append(mask_date(c, role).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*cols)


def tenant_filter(df: DataFrame, tenants: list[str] | None) -> DataFrame:
    """Rows of the role's tenants only (``None`` = all tenants)."""
    return df if tenants is None else df.where(F.col("company").isin(list(tenants)))
