from .config import CONFIG_DDL, load_data_checks, read_check_configs
from .landing import LandingArea, detect_files
