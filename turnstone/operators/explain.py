"""Attributions and their consumers.

Attributions are carried per row as an ordered ``array<struct<feature, shap>>``
(a map has no order). Top-k, filtering and sorting are higher-order array
functions, i.e. per-row work inside codegen, with no shuffle. Label lookup
is a broadcast join against fixed dictionaries of a few dozen rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Features a manager cannot act on (matched on the name's first "_" part).
UNACTIONABLE = ["Age", "Gender", "MaritalStatus", "DistanceFromHome", "NumCompaniesWorked",
                "TotalWorkingYears"]

# Display labels per feature name.
FEATURE_LABELS = {
    "Age": "Idade",
    "BusinessTravel": "Frequência de Viagem",
    "DailyRate": "Valor da Diária (R$)",
    "Department": "Departamento",
    "DistanceFromHome": "Distância de Casa (KM)",
    "Education": "Nível de Educação",
    "EducationField": "Área de Formação",
    "EmployeeCount": "Contagem de Funcionários",
    "EnvironmentSatisfaction": "Satisfação com o Ambiente",
    "Gender": "Gênero",
    "HourlyRate": "Valor da Hora (R$)",
    "JobInvolvement": "Nível de Envolvimento",
    "JobLevel": "Nível do Cargo",
    "JobRole": "Cargo",
    "JobSatisfaction": "Satisfação com o Trabalho",
    "MaritalStatus": "Estado Civil",
    "MonthlyIncome": "Renda Mensal (R$)",
    "MonthlyIncome_log": "Log da Renda Mensal",
    "MonthlyRate": "Valor Mensal (R$)",
    "NumCompaniesWorked": "Nº de Empresas Anteriores",
    "Over18": "Maior de 18 Anos?",
    "OverTime": "Faz Horas Extras?",
    "PercentSalaryHike": "Aumento Salarial (%)",
    "PerformanceRating": "Nota de Performance",
    "RelationshipSatisfaction": "Satisfação nos Relacionamentos",
    "StandardHours": "Horas Padrão de Trabalho",
    "StockOptionLevel": "Nível de Opção de Ações",
    "TotalWorkingYears": "Anos Totais de Carreira",
    "TotalWorkingYears_log": "Log dos Anos de Carreira",
    "TrainingTimesLastYear": "Treinamentos no Último Ano",
    "WorkLifeBalance": "Equilíbrio Vida-Trabalho",
    "YearsAtCompany": "Anos na Empresa",
    "YearsInCurrentRole": "Anos no Cargo Atual",
    "YearsPerCompany": "Média de Anos por Empresa",
    "YearsSinceLastPromotion": "Anos Desde a Última Promoção",
    "YearsWithCurrManager": "Anos com o Gestor Atual",
}

# Display labels per category value, in lookup order.
VALUE_LABELS = {
    "BusinessTravel": {"Non-Travel": "Não Viaja", "Travel_Rarely": "Viaja Raramente",
                       "Travel_Frequently": "Viaja Frequentemente"},
    "Department": {"Sales": "Vendas", "Research & Development": "Pesquisa & Desenvolvimento",
                   "Human Resources": "Recursos Humanos"},
    "EducationField": {"Life Sciences": "Ciências da Vida", "Medical": "Medicina",
                       "Marketing": "Marketing", "Technical Degree": "Formação Técnica",
                       "Other": "Outro", "Human Resources": "Recursos Humanos"},
    "Gender": {"Female": "Feminino", "Male": "Masculino"},
    "JobRole": {"Sales Executive": "Executivo de Vendas", "Research Scientist": "Pesquisador Cientista",
                "Laboratory Technician": "Técnico de Laboratório",
                "Manufacturing Director": "Diretor de Manufatura",
                "Healthcare Representative": "Representante de Saúde", "Manager": "Gerente",
                "Sales Representative": "Representante de Vendas",
                "Research Director": "Diretor de Pesquisa", "Human Resources": "Recursos Humanos"},
    "MaritalStatus": {"Single": "Solteiro(a)", "Married": "Casado(a)", "Divorced": "Divorciado(a)"},
    "OverTime": {"Yes": "Sim", "No": "Não"},
    "Over18": {"Y": "Sim"},
}

ATTR_TYPE = "array<struct<feature:string,shap:double>>"


def attribution_array(features: list[str], values: list[Column]) -> Column:
    """Pack per-feature attribution columns into the ordered array form."""
    return F.array(*[F.struct(F.lit(f).alias("feature"), v.cast("double").alias("shap"))
                     for f, v in zip(features, values)])


def top_factors(attr: Column, n: int = 5) -> Column:
    """Positive attributions, largest first, first ``n`` (ties keep catalogue order)."""
    pos = F.filter(attr, lambda x: x["shap"] > 0)
    srt = F.array_sort(pos, lambda a, b: F.when(a["shap"] > b["shap"], -1)
                       .when(a["shap"] < b["shap"], 1).otherwise(0))
    return F.slice(srt, 1, n)


def actionable(attr: Column, names=UNACTIONABLE) -> Column:
    """Drop factors whose name's first ``_`` part is unactionable."""
    bad = F.array(*[F.lit(x) for x in names])
    return F.filter(attr, lambda x: ~F.array_contains(bad, F.split(x["feature"], "_").getItem(0)))


def actionable_factors(attr: Column, n: int = 5, filter_first: bool = False) -> Column:
    """By default the cut to ``n`` happens first (so fewer than ``n`` may
    remain); ``filter_first=True`` filters before cutting."""
    if filter_first:
        return top_factors(actionable(attr), n)
    return actionable(top_factors(attr, n))


def abs_sorted(attr: Column) -> Column:
    """All attributions ordered by absolute value, largest first."""
    return F.array_sort(attr, lambda a, b: F.when(F.abs(a["shap"]) > F.abs(b["shap"]), -1)
                        .when(F.abs(a["shap"]) < F.abs(b["shap"]), 1).otherwise(0))


def explode_ranked(df: DataFrame, key: str, attr: str) -> DataFrame:
    """Long form (key, rank, feature, shap) with 1-based rank."""
    return df.select(key, F.posexplode(attr).alias("pos", "x")).select(
        key, (F.col("pos") + 1).alias("rank"), F.col("x.feature").alias("feature"), F.col("x.shap").alias("shap"))


def global_importance(df: DataFrame, attr: str = "attributions") -> DataFrame:
    """Mean |attribution| per feature (partial aggregation per feature)."""
    return (df.select(F.explode(attr).alias("x"))
              .groupBy(F.col("x.feature").alias("feature"))
              .agg(F.avg(F.abs(F.col("x.shap"))).alias("mean_abs_shap"))
              .orderBy(F.desc("mean_abs_shap"), "feature"))


def label_expr(name: Column) -> Column:
    """J7 as one projection: exact label, else the first ``<base>_`` prefix
    (dictionary order) rendered ``base label: value label`` (the value itself
    when it has no label), else the name with ``_`` as spaces. The
    dictionaries are fixed literals, so no join is needed at any size."""
    exact = F.create_map(*[F.lit(x) for kv in FEATURE_LABELS.items() for x in kv])
    values = F.create_map(*[F.lit(x) for base, m in VALUE_LABELS.items() for k, v in m.items()
                            for x in (f"{base}_{k}", v)])
    out = None
    for base in VALUE_LABELS:
        pref = base + "_"
        value = F.substring(name, len(pref) + 1, 1 << 30)
        rendered = F.concat(F.lit(FEATURE_LABELS.get(base, base) + ": "),
                            F.coalesce(F.try_element_at(values, F.concat(F.lit(pref), value)), value))
        hit = name.startswith(pref)
        out = F.when(hit, rendered) if out is None else out.when(hit, rendered)
    fallback = F.regexp_replace(name, "_", " ")
    prefixed = out.otherwise(fallback) if out is not None else fallback
    return F.coalesce(F.try_element_at(exact, name), prefixed)


def translate(df: DataFrame, col: str = "feature", out: str = "label") -> DataFrame:
    """J7 over any frame of feature names."""
    return df.withColumn(out, label_expr(F.col(col)))


def linear_attributions(df: DataFrame, terms: dict, coefs: dict, col: str = "attributions",
                        digits: int | None = None) -> DataFrame:
    """M14 for a linear margin: ``coef_i · (x_i − mean(x_i))`` per feature.

    The background means come from one aggregate pass (one number per
    feature) and are inlined; the rest is a per-row projection.
    """
    from turnstone.functions.exprs import round_half_up

    names = [n for n in terms if n in coefs]
    means = df.agg(*[F.avg(terms[n]).alias(f"m{i}") for i, n in enumerate(names)]).first()
    vals = []
    for i, n in enumerate(names):
        v = F.lit(float(coefs[n])) * (terms[n] - F.lit(float(means[f"m{i}"] or 0.0)))
        vals.append(round_half_up(v, digits) if digits is not None else v)
    return df.withColumn(col, attribution_array(names, vals))
