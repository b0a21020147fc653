"""One object with every question a user can ask of the tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.constants import IMPUTATION_CONSTANTS, RAW_FEATURES
from tidemark.functions.geodesy import add_osgb36
from tidemark.functions.postcode import canonical_postcode, postcode_district, postcode_sector
from tidemark.operators import impute, location, lookups, risk
from tidemark.operators.ranking import upsert
from tidemark.operators.scaling import cap_outliers
from tidemark.plans import models as m
from tidemark.plans.prices import with_price_fallback

Requests = DataFrame | Sequence


class NotFitted(RuntimeError):
    """The model has to be fitted first."""


class RiskEngine:
    """Postcode and flood-risk questions over distributed tables.

    Requests are lists or tables with an ``ord`` column. Answers hold one row
    per request and carry its columns; the look-ups and house prices come in
    request order, the others can be sorted by ``ord`` where order matters.
    """

    def __init__(
        self,
        units: DataFrame,
        sectors: DataFrame | None = None,
        districts: DataFrame | None = None,
        unlabelled: DataFrame | None = None,
        prepared_units: DataFrame | None = None,
        prepared_sectors: DataFrame | None = None,
        rainfall_stations: DataFrame | None = None,
        level_stations: DataFrame | None = None,
        forest: m.ForestSize | None = None,
        boosting: dict | None = None,
    ):
        self.spark = units.sparkSession
        self.units, self.sectors, self.districts = units, sectors, districts
        self.unlabelled = unlabelled
        self.prepared_units = units if prepared_units is None else prepared_units
        self.prepared_sectors = sectors if prepared_sectors is None else prepared_sectors
        self.rainfall_stations, self.level_stations = rainfall_stations, level_stations
        self.forest, self.boosting = forest or m.ForestSize(), boosting or {}
        self.models: dict[str, object] = {}
        self.postcodes = units.select(*RAW_FEATURES)
        if unlabelled is not None:
            self.postcodes = upsert(unlabelled.select(*RAW_FEATURES), self.postcodes, "postcode", newest_wins=False)

    # Requests -----------------------------------------------------------

    def requests(self, values: Requests) -> DataFrame:
        return values if isinstance(values, DataFrame) else lookups.requests_table(self.spark, values)

    def points(self, values: DataFrame | Sequence[tuple[float, float]], x: str, y: str) -> DataFrame:
        """Points with a unique ``ord``."""
        if isinstance(values, DataFrame):
            return values
        rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(values)]
        return self.spark.createDataFrame(rows, f"ord bigint, {x} double, {y} double")

    @staticmethod
    def _with_features(asked: DataFrame, features: DataFrame) -> DataFrame:
        """Stored features per request; the request rides along in a struct."""
        packed = asked.select("postcode", F.struct(*asked.columns).alias("_request"))
        return packed.join(features, "postcode", "left")

    @staticmethod
    def _request_columns(asked: DataFrame, *new: str) -> list:
        return [F.col(f"_request.{c}").alias(c) for c in asked.columns if c not in new]

    def _fitted(self, key: str):
        if key not in self.models:
            raise NotFitted(f"fit model {key!r} first")
        return self.models[key]

    def _extra(self, task: str, key: str, requests: DataFrame) -> DataFrame:
        if (task, key) not in m.EXTRA_BUILDERS:
            raise NotImplementedError(f"model {key} not implemented")
        if (task, key) not in self.models:
            raise NotFitted(f"fit model {key!r} first")
        return self.models[task, key](requests)

    # Fitting ------------------------------------------------------------

    def fit_to_data(
        self, models: str | Sequence[str] = (), unit_data: DataFrame | None = None, update_hyperparameters: bool = False
    ) -> RiskEngine:
        """Fit models, after taking in newer unit data if given.

        ``update_hyperparameters`` is accepted and changes nothing, as no
        tuning is defined.
        """
        if unit_data is not None:
            self.units = upsert(self.units, unit_data, "postcode")
            self.postcodes = upsert(self.postcodes, unit_data.select(*RAW_FEATURES), "postcode")
        own = {key for task, registry in m.REGISTRIES.items() for key in registry if (task, key) not in m.EXTRA_BUILDERS}
        for key in [models] if isinstance(models, str) else models:
            # Added models belong to their task, so equal keys of two tasks do not meet.
            added = [(task, name) for task, name in m.EXTRA_BUILDERS if name == key]
            for task in added:
                self.models[task] = m.EXTRA_BUILDERS[task](self)
            if key not in own:
                if not added:
                    raise ValueError(f"unknown model {key!r}")
            elif key == "seven_class_tool":
                fitted = m.SevenClassForest.fit(self.units, self.forest)
                fitted.reference = self.postcodes
                self.models[key] = fitted
            elif key == "historic_rf":
                self.models[key] = m.HistoricForest.fit(self.prepared_units, self._small_forest())
            elif key == "house_prices_xgb":
                self.models[key] = m.BoostedPrices.fit(self.prepared_units, self.prepared_sectors, **self.boosting)
            elif key == "modal_local_authority":
                self.models[key] = self.postcodes.where(F.col("localAuthority").isNotNull())
            elif key == "knn":
                self.models["knn_authority"] = self.models["knn_risk"] = self.units
            else:
                self.models[key] = key
        return self

    def _small_forest(self) -> m.ForestSize:
        return m.ForestSize(None, self.forest.depth, self.forest.seed)

    # Look-ups and cleaning ------------------------------------------------

    def lookup_easting_northing(self, postcodes: Requests) -> DataFrame:
        return lookups.lookup_grid(self.requests(postcodes), self.postcodes)

    def lookup_lat_long(self, postcodes: Requests) -> DataFrame:
        return lookups.lookup_wgs84(self.requests(postcodes), self.postcodes)

    def get_postcode_district_sector(self, postcodes: Requests) -> DataFrame:
        raw = F.col("postcode")
        return self.requests(postcodes).withColumns(
            {
                "postcodeSector": postcode_sector(raw),
                "postcodeDistrict": postcode_district(raw),
                "postcode": canonical_postcode(raw),
            }
        )

    def get_station_coordinates(self, readings: DataFrame, store_clean_value: bool = False) -> DataFrame:
        return lookups.reading_coordinates(readings, self.rainfall_stations, self.level_stations, store_clean_value)

    def handle_outliers_iqr(self, df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
        return cap_outliers(df, cols)

    def impute_missing_values(
        self, df: DataFrame, method: str = "postcode", constant_values: dict = IMPUTATION_CONSTANTS, k: int = 5
    ) -> DataFrame:
        if method == "postcode":
            return impute.by_postcode(df, self.units, constants=constant_values)
        if method == "knn":
            return impute.by_neighbours(df, self.units, k=k, constants=constant_values)
        if method == "constant":
            return impute.by_constant(df, constant_values)
        raise ValueError(f"unknown method {method!r}")

    def impute_district_property_age(self, districts: DataFrame, **size) -> DataFrame:
        return m.fill_age_shares(districts, **size)

    # Predictions ----------------------------------------------------------

    def predict_flood_class_from_postcode(self, postcodes: Requests, model: str = "all_minimum_risk") -> DataFrame:
        asked = self.requests(postcodes)
        if model == "all_minimum_risk":
            return location.minimum_risk(asked)
        if model == "seven_class_tool":
            scored = self._fitted(model).predict(self._with_features(asked, self.postcodes))
            return scored.select(*self._request_columns(asked, "riskLabel"), "riskLabel")
        return self._extra("flood_class_from_postcode", model, asked)

    def predict_flood_class_from_OSGB36_location(self, places, model: str = "all_minimum_risk") -> DataFrame:
        asked = self.points(places, "easting", "northing")
        if model == "all_minimum_risk":
            return location.minimum_risk(asked)
        if model == "seven_class_tool":
            found = self._fitted(model).predict_at(asked.select("ord", "easting", "northing"), "ord")
        elif model == "knn":
            found = location.knn_risk(asked, self._fitted("knn_risk"), "ord")
        else:
            return self._extra("flood_class_from_location", model, asked)
        return asked.join(found, "ord", "left")

    def predict_flood_class_from_WGS84_locations(self, places, model: str = "all_minimum_risk") -> DataFrame:
        """Places are (longitude, latitude) pairs."""
        asked = self.points(places, "longitude", "latitude")
        if model == "all_minimum_risk":
            return location.minimum_risk(asked)
        found = self.predict_flood_class_from_OSGB36_location(add_osgb36(asked), model)
        return found.select(*asked.columns, "riskLabel")

    def predict_median_house_price(self, postcodes: Requests, model: str = "all_england_median") -> DataFrame:
        asked = self.requests(postcodes)
        if model == "all_england_median":
            return location.england_median_price(asked)
        if model == "house_prices_xgb":
            wanted = asked.withColumn("postcode", canonical_postcode(F.col("postcode")))
            units = self.prepared_units.join(wanted.select("postcode"), "postcode", "left_semi")
            return with_price_fallback(wanted, self._fitted(model).predict(units, self.prepared_sectors))
        return self._extra("house_price", model, asked)

    def predict_local_authority(self, places, model: str = "modal_local_authority") -> DataFrame:
        asked = self.points(places, "easting", "northing")
        if model == "modal_local_authority":
            return location.modal_authority(asked, self._fitted(model))
        if model == "knn":
            return asked.join(location.knn_authority(asked, self._fitted("knn_authority"), "ord"), "ord", "left")
        return self._extra("local_authority", model, asked)

    def predict_historic_flooding(self, postcodes: Requests, model: str = "all_false") -> DataFrame:
        asked = self.requests(postcodes)
        if model == "all_false":
            return location.never_flooded(asked)
        if model == "random_classification":
            self._fitted(model)
            return asked.withColumn("historicallyFlooded", location.coin_flip(F.col("postcode")))
        if model == "historic_rf":
            scored = self._fitted(model).predict(self._with_features(asked, self.prepared_units))
            return scored.select(*self._request_columns(asked), "predictedHistoricFlooded")
        return self._extra("historic_flooding", model, asked)

    def predict_high_risk_near_watercourses(
        self,
        watercourses: Sequence[str],
        postcodes: Requests | None = None,
        risk_above: int = 4,
        model: str = "knn",
    ) -> DataFrame:
        units = self.units if self.unlabelled is None else self.unlabelled
        units = units.drop("riskLabel")
        if model == "knn":
            asked = units.select(F.col("postcode").alias("_asker"), "easting", "northing")
            found = location.knn_risk(asked, self._fitted("knn_risk"), "_asker")
            risks = found.withColumnRenamed("_asker", "postcode")
        else:
            risks = self.predict_flood_class_from_postcode(units.select("postcode"), model)
        wanted = None if postcodes is None else self.requests(postcodes)
        return risk.high_risk_near(units, risks, watercourses, wanted, risk_above)

    # Value and risk -------------------------------------------------------

    def estimate_total_value(self, postcodes: Requests) -> DataFrame:
        return risk.total_value(self.requests(postcodes), self.units, self.sectors)

    def _labels(self, asked: DataFrame, labels: DataFrame | None) -> DataFrame:
        return location.minimum_risk(asked.select("postcode").distinct()) if labels is None else labels

    def estimate_annual_human_flood_risk(self, postcodes: Requests, risk_labels: DataFrame | None = None) -> DataFrame:
        asked = self.requests(postcodes)
        return risk.human_risk(asked, self._labels(asked, risk_labels), self.sectors)

    def estimate_annual_economic_flood_risk(
        self, postcodes: Requests, risk_labels: DataFrame | None = None
    ) -> DataFrame:
        asked = self.requests(postcodes)
        return risk.economic_risk(asked, self._labels(asked, risk_labels), self.units, self.sectors)

    def flood_report(self, postcodes: Requests) -> DataFrame:
        """Stored features, true flag, predicted flag and its probability of known postcodes."""
        asked = self.requests(postcodes).select("postcode")
        known = self.prepared_units.join(asked, "postcode", "left_semi")
        return self._fitted("historic_rf").predict(known)
