import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fundlake.session import build_session  # noqa: E402
from fundlake.sources.catalog import tables_from_frames  # noqa: E402

FLOW = ("cnpj string, grupo_dfp string, dt_ini_exerc date, dt_fim_exerc date, fiscal_quarter int, "
        "cd_conta string, ds_conta string, vl_conta bigint")
BAL = "cnpj string, grupo_dfp string, dt_fim_exerc date, cd_conta string, ds_conta string, vl_conta bigint"
PRICES = "date date, ticker string, preult double, totneg bigint, quatot bigint, number_shares bigint"
TICKERS = ("ticker string, cnpj string, type string, sector string, subsector string, segment string, "
           "denom_social string, denom_comerc string")

NI = "Resultado Líquido das Operações Continuadas"
NI_B = "Lucro/Prejuízo do Período"


@pytest.fixture(scope="session")
def spark():
    s = build_session(2, app="fundlake-tests", shuffle_partitions=4)
    yield s


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def qend(year: int, q: int) -> dt.date:
    month = q * 3
    nxt = dt.date(year + (month == 12), month % 12 + 1, 1)
    return nxt - dt.timedelta(days=1)


def flow_row(cnpj, year, q, cd, ds, v, grupo="Consolidado", ini=None):
    return (cnpj, grupo, ini or dt.date(year, 1, 1), qend(year, q), q, cd, ds, v)


def ticker_row(ticker, cnpj, typ="ON", sector="S", subsector="SS", segment="SEG"):
    return (ticker, cnpj, typ, sector, subsector, segment, f"{cnpj} SA", f"{cnpj} SA")


@pytest.fixture
def make_tables(spark):
    def make(dre=(), dva=(), dfc=(), bpa=(), bpp=(), prices=(), tickers=()):
        return tables_from_frames(
            dre=spark.createDataFrame(list(dre), FLOW), dva=spark.createDataFrame(list(dva), FLOW),
            dfc=spark.createDataFrame(list(dfc), FLOW), bpa=spark.createDataFrame(list(bpa), BAL),
            bpp=spark.createDataFrame(list(bpp), BAL), prices=spark.createDataFrame(list(prices), PRICES),
            tickers=spark.createDataFrame(list(tickers), TICKERS))
    return make
