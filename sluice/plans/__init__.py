from .gold import build_gold, publish, rejected_gold_rows
from .landing import CUSTOMER_CONTRACT, MoveError, apply_data_contract, generate_drops, load_conforming, write_customer_drops
from .quality import check_and_publish, check_table_from_config
